"""python -m paperlake COMMAND IN OUT: the jobs of a corpus, from the command line.

metadata     a folder of harvested pages, or the address of a harvest -> metadata
pdfdownload  the manifest (XML) of a folder or address of archives -> these archives, gzipped, and a table `failed` of files that differ or aren't there
archives     a folder of archives of PDF -> id, text, error; what is there already is not done again
fulltext     a tree of text files -> texts by year and month
citations    texts (Parquet: id, text) -> id, refs
authorsplit  metadata (JSON lines) -> id, authors, error
graph        citations (Parquet: id, refs) -> one row of statistics
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from .functions import authors
from .operators import archives, citations, extraction, graph, metadata
from .sources import corpora, harvest, remote, tars


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("paperlake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["metadata", "pdfdownload", "archives", "fulltext", "citations", "authorsplit", "graph"])
    parser.add_argument("source")
    parser.add_argument("target")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName(f"paperlake {a.command}").getOrCreate()
    if a.command == "metadata":
        online = a.source.startswith(("http://", "https://"))
        harvest.register(spark, "harvested_pages", harvest.polite(remote.http(a.source), time.sleep, remote.busy) if online else harvest.folder(a.source))
        metadata.latest(metadata.records(spark.read.format("harvested_pages").load()), "id", "versions").write.parquet(a.target)
    elif a.command == "pdfdownload":
        files = remote.manifest(spark, a.source, f"{a.target}/manifest.xml.gz")
        got = remote.downloads(files, a.source.rsplit("/", 1)[0], a.target)
        got.where("error IS NOT NULL OR md5sum <> expected").write.mode("overwrite").json(f"{a.target}/failed")
    elif a.command == "archives":
        archives.process_parts(tars.members(spark, a.source), a.target, [extraction.within(f, 300) for f in extraction.pdf_tools()])
    elif a.command == "fulltext":
        corpora.write_fulltext(corpora.fulltext(spark, a.source), a.target)
    elif a.command == "citations":
        citations.extract(spark.read.parquet(a.source)).write.parquet(a.target)
    elif a.command == "authorsplit":
        rows = corpora.metadata(spark, a.source).select("id", authors.parse_authors("authors").alias("p"))
        rows.select("id", "p.authors", "p.error").write.parquet(a.target)
    else:
        refs = spark.read.parquet(a.source)
        graph.summary(refs.select("id"), graph.edges(refs, refs.select("id"))).write.json(a.target)


if __name__ == "__main__":
    main()
