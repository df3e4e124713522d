from barloom.streaming.landing import ingest_landed

__all__ = ["ingest_landed"]
