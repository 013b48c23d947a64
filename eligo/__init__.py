"""eligo: record-eligibility analytics on Spark DataFrames."""

from eligo.config import RunConfig, load_config  # noqa: F401
from eligo.operators.clean import clean_charges  # noqa: F401
from eligo.plans.classify import classify, classify_rows, split_tables  # noqa: F401
from eligo.plans.run import run_classification, run_ingestion  # noqa: F401
