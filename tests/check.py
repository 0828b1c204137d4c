"""Command line check: python -m tests.check [sf] [name prefix …]"""

from __future__ import annotations

import sys
import tempfile
import time

from lakeops.queries import ORACLES, QUERIES
from lakeops.session import get_spark
from tests.oracle import compare, connect


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "0.01"
    prefixes = tuple(argv[1:])
    sf_dir = f"/root/testdata/sf{sf}"
    shared = tempfile.TemporaryDirectory(prefix="lakeops-check-")
    spark = get_spark(master="local[8]", **{"spark.checkpoint.dir": f"file://{shared.name}",
                                            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, sf_dir)
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name:45s} {kind:4s} {time.time() - start:6.2f}s {' | '.join(problems)}",
              flush=True)
        failed += bool(problems)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
