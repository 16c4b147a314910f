"""Secret scan with corpus-wide ownership of what is found.

Texts are scanned for three base kinds and some further formats.  Every candidate's value is
hashed, and hashes are counted over the whole corpus by distinct repositories and owners: values
that several owners have, in several repositories, are copied examples; values of one owner, or of one
repository that several owners share, are live-looking credentials.
Base spans are always reported, spans of the further formats only if they look live.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import bounded, written

#: A value that so many owners have, in as many repositories, is a copied example.
COPIED = 3
#: Rows from which on a value is judged by a join of its own; a corpus of n rows has at most n / HOT such values.
HOT = 10_000
#: Bits a character that a live-looking value has at least.
ENTROPY = 3.0
KINDS = ("assign", "access", "hex", "github", "google", "jwt", "token")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs: the same as runs of any length, then dropping short ones
_MORE = {
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "google": re.compile(r"AIza[0-9A-Za-z_-]{35}"),
    "jwt": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    "token": re.compile(r"[A-Za-z0-9+/_=-]{24,}"),
}
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])")
_FOUND = "array<struct<kind: int, start: int, end: int, hash: string, random: boolean>>"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds: leftmost, not overlapping within a kind."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def more_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Spans of the further formats that no base span and no earlier format overlaps."""
    out: list[tuple[int, int, int, str]] = []
    # Taken stretches, disjoint and in order.
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b, _ in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for name, pattern in _MORE.items():
        for m in pattern.finditer(text):
            if name == "token" and not _MIXED.match(m[0]):
                continue
            i = bisect_right(starts, m.start())
            if (i == 0 or ends[i - 1] <= m.start()) and (i == len(starts) or m.end() <= starts[i]):
                out.append((m.start(), KINDS.index(name), m.end(), m[0]))
                starts.insert(i, m.start())
                ends.insert(i, m.end())
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            base = base_spans(text)
            found = [
                {"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "random": entropy(v) >= ENTROPY}
                for a, k, b, v in base + more_spans(text, base)
            ]
            digest = hashlib.sha256(joined([s[:3] for s in base]).encode()).hexdigest()
            rows.append((*(sum(s[1] == k for s in base) for k in range(3)), digest, found))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "found"])
        yield pd.concat([batch.drop(columns="text").reset_index(drop=True), out], axis=1)


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Candidates of every row: ``row`` (hash of the whole row's inputs), doc_id, repository, owner, counts, found."""
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce("text", F.lit("")).alias("text"),
    )
    keyed = source.select(F.xxhash64("doc_id", "repository", "owner", "text").alias("row"), "*")
    kinds = f"row bigint, doc_id bigint, repository string, owner string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, found {_FOUND}"
    return keyed.mapInPandas(_scan, kinds)


def ownership(scanned: DataFrame) -> DataFrame:
    """Per candidate hash: n_rows, n_repositories, n_owners, and whether it is a copied example."""
    each = scanned.select("repository", "owner", F.explode("found.hash").alias("hash"))
    counted = each.groupBy("hash", "repository", "owner").agg(F.count("*").alias("n"))
    return counted.groupBy("hash").agg(
        F.sum("n").alias("n_rows"), F.countDistinct("repository").alias("n_repositories"), F.countDistinct("owner").alias("n_owners")
    ).withColumn("copied", (F.col("n_owners") >= COPIED) & (F.col("n_repositories") >= COPIED))


def _judged(each: DataFrame, known: DataFrame, hot: int = HOT) -> DataFrame:
    """``each`` candidate with its value's verdict.

    Widely copied values, hot keys by nature, are few: they meet a table of their own, whose size is
    checked, so their rows stay where they are.  The others have fewer than ``hot`` rows a key.
    """
    common = written(known.where(F.col("n_rows") >= hot).select("hash", F.col("copied").alias("_common")))
    told = each.join(bounded(common), "hash", "left")
    frequent = told.where(F.col("_common").isNotNull()).withColumnRenamed("_common", "copied")
    rare = told.where(F.col("_common").isNull()).drop("_common").join(known.where(F.col("n_rows") < hot).select("hash", "copied"), "hash")
    return frequent.unionByName(rare)


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Every row of ``docs`` with its secrets.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live and n_copied (candidates
    of either sort).  Null texts are empty texts, null owners are one owner and null repositories one repository; repeated rows come out
    alike; other columns are ignored; an empty table gives no rows.
    """
    scanned = written(scan(docs, repository, owner))
    known = written(ownership(scanned).select("hash", "n_rows", "copied"))
    each = scanned.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*").distinct()
    judged = _judged(each, known).withColumn("live", ~F.col("copied") & F.col("random"))
    shown = F.when((F.col("kind") < 3) | F.col("live"), F.struct("start", "kind", "end"))
    names = F.array(*[F.lit(k) for k in KINDS])
    by_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(shown)).alias("shown"),
        F.sum(F.col("live").cast("bigint")).alias("n_live"), F.sum(F.col("copied").cast("bigint")).alias("n_copied"),
    )
    spans = F.array_join(F.transform("shown", lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    return scanned.join(by_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(spans, F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
