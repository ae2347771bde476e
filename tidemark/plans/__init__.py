from tidemark.plans.clean import ChildTable, CleanJob, run_clean
from tidemark.plans.curated import ChildLists, CuratedJob, Dimension, build_curated, run_curated
from tidemark.plans.mart import compact_mart, mart_delta, mart_stage, read_mart, run_mart
from tidemark.plans.reference import load_reference
from tidemark.plans.visits import Visits, visit_rules

__all__ = [
    "ChildLists",
    "ChildTable",
    "CleanJob",
    "CuratedJob",
    "Dimension",
    "Visits",
    "build_curated",
    "compact_mart",
    "load_reference",
    "mart_delta",
    "mart_stage",
    "read_mart",
    "run_clean",
    "run_curated",
    "run_mart",
    "visit_rules",
]
