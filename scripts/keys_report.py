"""Write the index of registered keys (KEYS.md) from the catalog.

usage: python scripts/keys_report.py > KEYS.md
"""

from __future__ import annotations

import inspect
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    import tessera.plans.catalog as catalog

    src = inspect.getsource(catalog)
    rows = []
    for keys, fn in re.findall(r'@register\(([^)]*)\)\ndef (\w+)\(', src):
        f = getattr(catalog, fn)
        doc = (inspect.getdoc(f) or "").replace("\n", " ").replace("|", "\\|")
        body = inspect.getsource(f).splitlines()
        call = next((ln.strip() for ln in body if ln.strip().startswith("return")), "")
        for k in re.findall(r'"(\w+)"', keys):
            rows.append((k, doc, call.replace("|", "\\|")))
    print("# Registered keys\n")
    print("Every key of `__spark_entry__.queries()` (each with an oracle in `duck_oracle/queries.py`),")
    print("with the catalog entry's description (SURVEY section 2 IDs in parentheses) and the")
    print("library call it makes. Generated by `scripts/keys_report.py`.\n")
    print("| Key | What (SURVEY IDs) | Call |")
    print("|---|---|---|")
    for k, doc, call in rows:
        print(f"| `{k}` | {doc} | `{call[:110]}` |")
    print(f"\n{len(rows)} keys. Not registered: `inline_rows` (S3/S4), which would run on fixed literal rows only;")
    print("it is exercised by `tests/test_retail_golden.py`.")


if __name__ == "__main__":
    main()
