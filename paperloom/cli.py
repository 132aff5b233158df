"""Command line: converts a corpus folder (``blocks.parquet``, ``papers.parquet``) or XML files.

    python -m paperloom.cli CORPUS -o OUT [--xml GLOB] [--limit N] [--no-links] [--keep-boundaries] [--headless]
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import functions as F

from paperloom.operators import metadata as MD
from paperloom.operators import xmldoc as XD
from paperloom.plans.pipeline import write_corpus
from paperloom.session import get_spark, table
from paperloom.settings import Settings
from paperloom.sources.staging import read_xml


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paperloom", description=__doc__.split("\n")[0])
    p.add_argument("target", help="folder of the corpus tables")
    p.add_argument("-o", "--output-dir", required=True)
    p.add_argument("--xml", metavar="GLOB", help="XML files to read as blocks and metadata instead of tables")
    p.add_argument("--limit", type=int, help="convert only so many papers, the first by paper_id")
    p.add_argument("--no-links", action="store_true")
    p.add_argument("--keep-boundaries", action="store_true", help="do not cut articles to their boundaries")
    p.add_argument("--headless", action="store_true", help="print progress events as JSON lines")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    began = time.time()

    def say(kind: str, **what: object) -> None:
        if a.headless:
            print(json.dumps({"event": kind, **what}), flush=True)

    spark = get_spark("paperloom")
    s = Settings.from_env()
    s = Settings(**{**s.__dict__, "inject_links": s.inject_links and not a.no_links, "article_boundary": s.article_boundary and not a.keep_boundaries})
    say("start", target=a.target)
    if a.xml:
        docs = read_xml(spark, a.xml).withColumn("xml_id", F.xxhash64("path"))
        names = docs.select("xml_id", "paper_id")
        XD.xml_metadata(docs).join(names, "xml_id").write.mode("overwrite").parquet(f"{a.output_dir}/papers")
        XD.xml_blocks(docs).join(names, "xml_id").write.mode("overwrite").parquet(f"{a.output_dir}/blocks")
    else:
        blocks, papers = table(spark, a.target, "blocks"), MD.latest(table(spark, a.target, "papers"))
        if a.limit:
            some = papers.select("paper_id").orderBy("paper_id").limit(a.limit)
            blocks, papers = blocks.join(some, "paper_id", "left_semi"), papers.join(some, "paper_id", "left_semi")
        write_corpus(blocks, papers, a.output_dir, s)
    say("done", percent=100, seconds=round(time.time() - began, 1))
    return 0


if __name__ == "__main__":
    sys.exit(main())
