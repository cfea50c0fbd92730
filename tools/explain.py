"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py <sf_dir> <query> [<query> ...] [--brief]

``--brief`` prints only the operator tree plus scan locations, pushed
filters and read schemas.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    brief = "--brief" in argv
    args = [a for a in argv if a != "--brief"]
    sf_dir, names = args[0], args[1:]
    from squall.plans import queries
    from squall.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    qs = queries()
    for name in names:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        print(f"===== {name}")
        if not brief:
            print(text)
            continue
        for line in text.splitlines():
            s = line.strip()
            if s.startswith(("+-", ":", "AdaptiveSparkPlan")) or s.startswith(
                    ("Location:", "PushedFilters:", "ReadSchema:")):
                print(line)


if __name__ == "__main__":
    main(sys.argv[1:])
