"""A server over standard input and output: python -m scriptorium.serve INDEX_FOLDER.

One JSON-RPC message a line either way; each answer is flushed as soon as it is written. Ends with the input.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable
from typing import TextIO

from pyspark.sql import SparkSession

from scriptorium.operators import rpc
from scriptorium.operators.search import Search


def run(search: Search, lines: Iterable[str], out: TextIO) -> None:
    for answer in rpc.serve(lambda name, arguments: rpc.dispatch(search, name, arguments), lines):
        out.write(answer)
        out.flush()


def main(arguments: list[str]) -> int:
    if len(arguments) != 1:
        print("usage: python -m scriptorium.serve INDEX_FOLDER", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("scriptorium").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    run(Search.open(spark, arguments[0]), sys.stdin, sys.stdout)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
