"""Pages and files over HTTP: the harvest's fetcher, and downloads that are checked and can be taken up again."""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.error import HTTPError
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .corpora import manifest_xml
from .harvest import Fetcher, Page, request

#: Bytes that are read at a time.
CHUNK = 1 << 20


class Refused(Exception):
    """The server asks to wait."""

    def __init__(self, seconds: float):
        super().__init__(f"asked to wait {seconds} seconds")
        self.seconds = seconds


def busy(error: Exception) -> float | None:
    """For harvest.polite: seconds to wait, or None for any other error."""
    return error.seconds if isinstance(error, Refused) else None


def next_token(xml: str) -> str | None:
    m = re.search(r"<resumptionToken\b[^>]*>\s*([^<]*?)\s*</resumptionToken>", xml)
    return m[1] if m and m[1] else None


def http(base: str, prefix: str = "arXivRaw", opener: Callable = urlopen, patience: float = 20) -> Fetcher:
    """Pages of a harvest endpoint. 503 raises Refused with what Retry-After says; an error in the answer raises too."""

    def fetch(token: str | None) -> Page:
        try:
            with opener(request(base, token, prefix)) as answer:
                xml = answer.read().decode("utf-8")
        except HTTPError as e:
            if e.code == 503:
                raise Refused(float(e.headers.get("Retry-After") or patience)) from e
            raise
        if failed := re.search(r'<error\s+code="([^"]*)"[^>]*>([^<]*)', xml):
            raise RuntimeError(f"{failed[1]}: {failed[2].strip()}")
        return xml, next_token(xml)

    return fetch


def download(url: str, target: str, again: bool = False, dry: bool = False, opener: Callable = urlopen) -> str:
    """Fetches a file to `target`, gzipped, and returns the md5 of its plain bytes. A file that is there is only hashed,
    unless `again`; a dry run fetches nothing and returns the md5 of nothing. What is written appears under its name
    when it is whole, so a task that is lost half-way leaves nothing that looks finished."""
    digest = hashlib.md5()
    if dry:
        return digest.hexdigest()
    if os.path.exists(target) and not again:
        with gzip.open(target, "rb") as f:
            while part := f.read(CHUNK):
                digest.update(part)
        return digest.hexdigest()
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    part_name = f"{target}.{uuid.uuid4().hex}.part"
    try:
        with opener(url) as source, gzip.open(part_name, "wb") as f:
            while part := source.read(CHUNK):
                digest.update(part)
                f.write(part)
        os.replace(part_name, target)
    finally:
        if os.path.exists(part_name):
            os.remove(part_name)
    return digest.hexdigest()


def manifest(spark: SparkSession, url: str, target: str, again: bool = False, opener: Callable = urlopen) -> DataFrame:
    """The files of a manifest, fetched if it isn't there yet. target: a path that all executors see, ending in .gz."""
    download(url, target, again, opener=opener)
    return manifest_xml(spark, target)


def downloads(files: DataFrame, base: str, folder: str, again: bool = False, dry: bool = False) -> DataFrame:
    """filename, md5sum (of what came), expected, error: fetches the files of a manifest to a folder that all executors
    see, each once; a failure is kept with its file. Run again, it takes up what is missing."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sums, errors = [], []
            for name in f["filename"]:
                try:
                    sums.append(download(f"{base.rstrip('/')}/{name}", f"{folder}/{os.path.basename(name)}.gz", again, dry))
                    errors.append(None)
                except Exception as e:  # kept with the file; the others go on
                    sums.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"filename": f["filename"], "md5sum": sums, "expected": f["md5sum"], "error": errors})

    rows = files.select("filename", "md5sum").dropDuplicates(["filename"]).repartition("filename")
    return rows.mapInPandas(run, "filename string, md5sum string, expected string, error string")
