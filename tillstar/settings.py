"""Job settings: command line first, then the environment, then defaults."""

import argparse
import os
from dataclasses import dataclass
from datetime import datetime

from tillstar.sources.warehouse import DEFAULT_SEED


@dataclass(frozen=True)
class Settings:
    source: str
    warehouse: str
    seed: datetime = DEFAULT_SEED
    reset: bool = False
    multi_line: bool = False
    stream: bool = False
    lenient: bool = False
    customers: str = "insert"
    input_gb: float | None = None


def parse(arguments=None, environment=os.environ):
    parser = argparse.ArgumentParser(prog="tillstar", description="Load invoice lines into the star")
    parser.add_argument("--source", default=environment.get("TILLSTAR_SOURCE", "data/raw/data.csv"))
    parser.add_argument("--warehouse", default=environment.get("TILLSTAR_WAREHOUSE", "warehouse"))
    parser.add_argument(
        "--seed", type=datetime.fromisoformat, default=DEFAULT_SEED,
        help="high-water mark to start from when the warehouse is created",
    )
    parser.add_argument("--reset", action="store_true", help="drop and create the tables first")
    parser.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks")
    parser.add_argument("--stream", action="store_true", help="load a folder of CSV files as a stream")
    parser.add_argument(
        "--lenient", action="store_true", help="set bad lines aside instead of failing the batch"
    )
    parser.add_argument(
        "--customers", choices=["insert", "update", "history"], default="insert",
        help="what to do with known customers: leave them, take over later values, or keep versions",
    )
    parser.add_argument(
        "--input-gb", type=float,
        help="size of a batch, to size the shuffles for it instead of what the files' size says",
    )
    return Settings(**vars(parser.parse_args(arguments)))
