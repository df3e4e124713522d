from barloom.plans.bars import get_bars
from barloom.plans.clean import clean_equities, clean_futures, equity_rejections, screen_equities
from barloom.plans.ingest import IngestResult, backfill, backfill_resumable, backfill_stored, ingest, universe_of
from barloom.plans.universe import build_universe

__all__ = [
    "IngestResult", "backfill", "backfill_resumable", "backfill_stored", "build_universe", "clean_equities", "clean_futures", "equity_rejections",
    "get_bars", "ingest", "screen_equities", "universe_of",
]
