"""Documents to text through plug-in extractors, and batches of text to embeddings through plug-in encoders."""

from __future__ import annotations

import hashlib
import multiprocessing
import os
import subprocess
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Extractor = Callable[[bytes], str]
#: Characters of texts that a task holds before it passes them on.
HELD = 4 << 20


def within(extractor: Extractor, seconds: float) -> Extractor:
    """The extractor in a process of its own, which is ended when it takes longer: a file that hangs costs its time and
    not the task."""

    def work(pipe, content: bytes) -> None:
        try:
            pipe.send((extractor(content), None))
        except BaseException as e:
            pipe.send((None, f"{type(e).__name__}: {e}"))

    def run(content: bytes) -> str:
        fork = multiprocessing.get_context("fork")
        here, there = fork.Pipe(False)
        child = fork.Process(target=work, args=(there, content))
        child.start()
        there.close()
        try:
            if not here.poll(seconds):
                raise TimeoutError(f"more than {seconds:g} seconds")
            text, error = here.recv()
        except EOFError:
            text, error = None, "the extractor ended without a text"
        finally:
            child.kill()
            child.join()
            here.close()
        if error:
            raise RuntimeError(error)
        return text

    return run


def command(*line: str, seconds: float = 120, suffix: str = ".pdf") -> Extractor:
    """An external tool with a time limit. line: its words, of which IN and OUT stand for the file's path and the text's."""

    def run(content: bytes) -> str:
        with tempfile.TemporaryDirectory() as folder:
            at = {"IN": os.path.join(folder, f"in{suffix}"), "OUT": os.path.join(folder, "out.txt")}
            with open(at["IN"], "wb") as f:
                f.write(content)
            done = subprocess.run([at.get(w, w) for w in line], timeout=seconds, capture_output=True, check=False)
            if done.returncode or not os.path.exists(at["OUT"]):
                raise RuntimeError(done.stderr.decode("utf-8", "replace").strip()[-500:] or f"status {done.returncode}")
            with open(at["OUT"], encoding="utf-8", errors="replace") as f:
                return f.read()

    return run


def pdf_tools(seconds: float = 120) -> list[Extractor]:
    """The usual tools for PDF, in the order in which they are tried; the last one reads the layout anew."""
    return [command("pdftotext", "IN", "OUT", seconds=seconds), command("pdf2txt.py", "-o", "OUT", "IN", seconds=seconds), command("pdf2txt.py", "-A", "-o", "OUT", "IN", seconds=seconds)]


def extract(files: DataFrame, extractors: list[Extractor], normalise: Callable[[str], str] = lambda t: t, most: float = 45.0) -> DataFrame:
    """id, text, error: the first extractor whose text has words of `most` characters or fewer on average. Files: id,
    content. A file that all fail on keeps the last error; the others go on."""

    def one(content: bytes | None) -> tuple[str | None, str | None]:
        error = "empty file"
        for f in extractors if content else ():
            try:
                text = normalise(f(bytes(content)))
                if len(text) / (len(text.split()) + 1) <= most:
                    return text, None
                error = "no words"
            except Exception as e:  # kept with the file
                error = f"{type(e).__name__}: {e}"
        return None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out, size = b.column(0), [], 0
            for i in range(b.num_rows):  # one by one: a batch may hold ten thousand files
                out.append(one(b.column(1)[i].as_py()))
                size += len(out[-1][0] or "")
                if size > HELD or i == b.num_rows - 1:
                    texts, errors = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([ids.slice(i + 1 - len(out), len(out)), pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["id", "text", "error"])
                    out, size = [], 0

    return files.select(F.col("id").cast("string").alias("id"), "content").mapInArrow(run, "id string, text string, error string")


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files without a finished text."""
    return files.join(done.select("id"), "id", "left_anti")


def hashed_bag(texts: list[str], dim: int = 64) -> np.ndarray:
    """A deterministic stand-in for a trained encoder: words signed and placed by their md5, of unit length."""
    out, seen = np.zeros((len(texts), dim)), {}
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = seen.get(w)
            if h is None:
                h = seen[w] = int(hashlib.md5(w.encode("utf-8", "surrogatepass")).hexdigest()[:15], 16)
            out[i, h // 2 % dim] += 1 if h % 2 else -1
    return (out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


def embed(fulltext: DataFrame, encoder: Callable[[list[str]], np.ndarray] = hashed_bag) -> DataFrame:
    """id, embedding of fulltext (id, text), a batch at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "embedding": list(encoder([t or "" for t in f["text"]]))})

    return fulltext.select("id", "text").mapInPandas(run, "id string, embedding array<float>")


Encoder = Callable[[list[str]], np.ndarray]
#: What a worker has loaded, by name: workers are reused, so a model is loaded once a worker and not once a task.
_MODELS: dict[str, Encoder] = {}


def loaded(name: str, load: Callable[[], Encoder]) -> Encoder:
    if name not in _MODELS:
        _MODELS.clear()  # one at a time: models are large
        _MODELS[name] = load()
    return _MODELS[name]


def by_length(texts: list[str], most: int) -> Iterator[list[int]]:
    """Places of texts in batches of like length: as many as fill `most` characters, each counted as long as the longest, or
    one longer text. Encoders that pad so waste little, and none gets more than it can hold."""
    batch, longest = [], 0
    for i in sorted(range(len(texts)), key=lambda i: (len(texts[i]), i)):
        if batch and max(longest, len(texts[i])) * (len(batch) + 1) > most:
            yield batch
            batch, longest = [], 0
        batch.append(i)
        longest = max(longest, len(texts[i]), 1)
    if batch:
        yield batch


def embed_loaded(fulltext: DataFrame, name: str, load: Callable[[], Encoder], most: int = 1 << 16) -> DataFrame:
    """id, embedding of fulltext (id, text) by an encoder that load() gives, known by `name` (with its version: another name
    is another model). Rows leave in the order in which they came; a null text is an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts, out = [t or "" for t in f["text"]], [None] * len(f)
            for batch in by_length(texts, most):
                for i, v in zip(batch, loaded(name, load)([texts[i] for i in batch]), strict=True):
                    out[i] = v
            yield pd.DataFrame({"id": f["id"], "embedding": out})

    return fulltext.select("id", "text").mapInPandas(run, "id string, embedding array<float>")


def token_triples(tokens: DataFrame) -> DataFrame:
    """Token ids as sparse coordinates: id, position, token."""
    return tokens.select("id", F.posexplode("ids").alias("position", "token"))
