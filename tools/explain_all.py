"""Write the physical operator tree of every registered query to PLANS.md.

    python tools/explain_all.py [sf_dir] [out.md]

Uses ``explain("formatted")`` and keeps the operator tree (the per-node
details are omitted for length). Queries are planned, not executed.
"""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from phonesense.plans import catalog  # noqa: E402
from phonesense.session import get_session  # noqa: E402


KEEP = ("Scan", "Exchange", "Join", "WindowGroupLimit", "BroadcastExchange")
DETAILS = ("Arguments:", "ReadSchema:", "PartitionFilters:", "PushedFilters:", "Join type:", "Left keys:",
           "Right keys:")


def tree(df) -> str:
    """Operator tree, then the details that decide data movement."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = buf.getvalue().splitlines()
    out, i = [], 1
    while i < len(lines) and lines[i].strip():
        out.append(lines[i].rstrip())
        i += 1
    details, node = [], None
    for line in lines[i:]:
        if line.startswith("(") and ")" in line:
            node = line.strip() if any(k in line for k in KEEP) else None
            if node:
                details.append(node)
        elif node and line.strip().startswith(DETAILS):
            text = line.strip()
            details.append("    " + (text if len(text) <= 160 else text[:110] + " ... " + text[-45:]))
    return "\n".join(out + ([""] + details if details else []))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    target = Path(sys.argv[2]) if len(sys.argv) > 2 else ROOT / "PLANS.md"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    parts = ["# Physical plans of the registered queries",
             "",
             f"Generated by `python tools/explain_all.py` on `{Path(sf_dir).name}` "
             f"(Spark {spark.version}, AQE on; the tree is the initial plan AQE starts from).",
             "Source derivation shared by every query: `events` scan → under-split repartition → "
             "JSON build → `parse_json` + `posexplode` (no shuffle).", ""]
    for name in catalog.PLANS:
        parts += [f"## {name}", "", "```", tree(catalog.bind(name)(spark, sf_dir)), "```", ""]
    target.write_text("\n".join(parts))
    print(f"wrote {target}")


if __name__ == "__main__":
    main()
