"""`python -m palaver.cli` with `list`, `run QUERY FOLDER OUT`, `explain QUERY FOLDER`, `organize`, `preprocess` and `errors`.

`preprocess EXPORTS OUT --system TEXT --task TEXT [--config FILE]` turns chat exports into training files and prints its counts;
`organize PLAN MANIFEST KEYS` prints how many items of a plan (JSON lines) a manifest doesn't record yet; `errors EXPORTS`
lists the exports that can't be read.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from palaver.operators import manifest
from palaver.plans import config, further, more, prepare, registry  # noqa: F401
from palaver.sources import chat


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="palaver")
    verbs = parser.add_subparsers(dest="verb", required=True)
    verbs.add_parser("list")
    for verb, fields in (("run", ("query", "folder", "out")), ("explain", ("query", "folder"))):
        one = verbs.add_parser(verb)
        for field in fields:
            one.add_argument(field, choices=sorted(registry.QUERIES) if field == "query" else None)
    made = verbs.add_parser("preprocess")
    for field in ("exports", "out"):
        made.add_argument(field)
    for field in ("system", "task", "config"):
        made.add_argument(f"--{field}")
    made.add_argument("--include-system", action="store_true")
    made = verbs.add_parser("organize")
    for field in ("plan", "manifest", "keys"):
        made.add_argument(field)
    verbs.add_parser("errors").add_argument("exports")
    found = parser.parse_args(args)
    if found.verb == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if found.verb == "preprocess":
        tree = config.load(found.config) if found.config else {}
        tree |= {k: getattr(found, k) for k in ("system", "task") if getattr(found, k) is not None}
        raw = chat.messages(chat.files(spark, found.exports), found.include_system)
        for row in prepare.write(spark, raw, prepare.settings_of(tree), found.out).orderBy("stage", "what").toLocalIterator():
            print(f"{row.stage}\t{row.what}\t{row.n}")
        return 0
    if found.verb == "organize":
        keys = found.keys.split(",")
        manifest.summary(spark.read.json(found.plan), spark.read.json(found.manifest), keys).show(truncate=False)
        return 0
    if found.verb == "errors":
        for row in chat.parse_errors(chat.files(spark, found.exports)).orderBy("source_file").toLocalIterator():
            print(f"{row.source_file}\t{row.reason}")
        return 0
    rows = registry.QUERIES[found.query](spark, found.folder)
    if found.verb == "run":
        rows.write.parquet(found.out)
    else:
        rows.explain("formatted")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
