"""Exact removal of repeated passages: windows of words counted through super-k-mers.

A window is ``WIDTH`` consecutive words of one text.  Its minimiser is the ``CORE`` of its words with
the least hash (the leftmost of equal ones), so equal windows have equal minimisers.  Consecutive
windows of a text that share the occurrence of a minimiser travel as one packed string, a
super-k-mer, to the bucket of that minimiser, and every window of a bucket is counted there by
sorting: word numbers are paired up to ranks of 2, 4, ... words until the ranks stand for whole
windows.  Nothing but word sequences decides; hashes only choose buckets.

* Rows with the same text are one row with a weight from the start.
* The windows of one super-k-mer all differ (each holds its minimiser at another place), so only
  buckets with several need counting.  A first pass counts the super-k-mers of every bucket; a Bloom
  filter of bounded size keeps the others at home.  What it lets through by mistake is found to be
  alone later.
* A bucket of very many super-k-mers (a core that very many contexts share) isn't gathered by one
  task: its windows are counted one by one under a cryptographic digest.  Both ways give the same
  result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.bloom import Bloom, bloom_of
from ebbline.operators.ranking import COPIES, salted_join
from ebbline.session import bounded, discard, written

WIDTH, CORE = 35, 6
SEED = 7
#: Super-k-mers that a bucket holds at most if it is counted by one task.
HEAVY = 1 << 15
#: Keys with this many rows are looked up apart from the others.
HOT = 10_000
#: Bytes of text, and words of packed strings, that a task works on at once.
PART, CHUNK = 1 << 20, 1 << 18
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when it holds ``size`` words."""

    size = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, SEED)
        return h


def split_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return [] if text is None else text.split()


def minimisers(hashes: np.ndarray, width: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """``(value, moved)`` for the window that starts at each word: the hash of its least core, and whether
    that is another core, or another place of an equal one, than in the window before.

    ``hashes`` are the words' hashes; there is one entry per window of the sequence.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    cores = np.full(len(hashes) - core + 1, core, np.uint64)
    for k in range(core):
        cores = (cores ^ hashes[k : k + len(cores)]) * _MIX[0]
        cores ^= cores >> np.uint64(29)
    cores = (cores ^ (cores >> np.uint64(30))) * _MIX[1]
    cores = (cores ^ (cores >> np.uint64(27))) * _MIX[2]
    cores ^= cores >> np.uint64(31)
    span, reach, value = width - core + 1, 1, cores
    while reach < span:
        step = min(reach, span - reach)
        value = np.minimum(value[:-step], value[step:])
        reach += step
    # A window that begins with its least core leaves it behind.
    moved = np.ones(n, bool)
    moved[1:] = (value[1:] != value[:-1]) | (cores[: n - 1] == value[:-1])
    return value, moved


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Texts of a batch split into words, some megabytes at a time."""
    for batch in batches:
        ends = batch["text"].str.len().cumsum().to_numpy()
        for _, part in batch.groupby(ends // PART):
            yield part, [split_words(t) for t in part["text"]]


def _runs(words: list[list[bytes]], hashes: _Hashes, width: int, core: int):
    """Super-k-mers of several texts: (text, first window, windows, bucket), arrays of equal length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    value, moved = minimisers(flat, width, core)
    first = np.cumsum(sizes) - sizes
    # Windows that lie in one text; the first of a text follows a gap and begins a run.
    inside = np.zeros(len(value) + 1, np.int32)
    whole = sizes >= width
    np.add.at(inside, first[whole], 1)
    np.add.at(inside, (first + sizes - width + 1)[whole], -1)
    inside = np.cumsum(inside[:-1]) > 0
    at = np.flatnonzero(inside & (moved | ~np.concatenate([[False], inside[:-1]])))
    if not len(at):
        return (np.empty(0, np.int64),) * 4
    owner = np.searchsorted(first, at, side="right") - 1
    last = np.minimum(np.append(at[1:], len(flat)), (first + sizes - width + 1)[owner])
    return owner, at - first[owner], last - at, value[at].astype(np.int64)


def _super_kmers(batches: Iterator[pd.DataFrame], width: int, core: int, shared: Bloom) -> Iterator[pd.DataFrame]:
    hashes = _Hashes()
    for part, words in _parts(batches):
        runs = _runs(words, hashes, width, core)
        owner, at, windows, bucket = (x[shared.holds(runs[3].view(np.uint64))] for x in runs)
        packed = [b" ".join(words[o][a : a + w + width - 1]) for o, a, w in zip(owner.tolist(), at.tolist(), windows.tolist())]
        yield pd.DataFrame(
            {
                "bucket": bucket, "tid": part["tid"].to_numpy()[owner], "at": at, "windows": windows,
                "n": part["n"].to_numpy()[owner], "packed": pd.Series(packed, dtype=object),
            }
        )


def _bucket_sizes(batches: Iterator[pd.DataFrame], width: int, core: int) -> Iterator[pd.DataFrame]:
    """Super-k-mers per bucket, and how many rows have them."""
    hashes = _Hashes()
    for part, words in _parts(batches):
        owner, _, _, bucket = _runs(words, hashes, width, core)
        rows = pd.DataFrame({"bucket": bucket, "kmers": 1, "n": part["n"].to_numpy()[owner]})
        yield rows.groupby("bucket", as_index=False).sum()


def window_ranks(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for the ``width`` ids from each place on; equal numbers for equal sequences only."""
    reach, now = 1, ids
    while reach < width:
        step = min(reach, width - reach)
        pairs = now[:-step] * (int(now.max()) + 1) + now[step:]
        now = np.unique(pairs, return_inverse=True)[1]
        reach += step
    return now


def _repeated(rows: pd.DataFrame, width: int) -> Iterator[tuple[int, int, int]]:
    """``(tid, start, stop)`` word ranges of the repeated windows of whole buckets."""
    number, distinct = pd.factorize(rows["packed"])
    weight = np.bincount(number, weights=rows["n"].to_numpy(), minlength=len(distinct))
    # One row per distinct super-k-mer; alone in its bucket and seen once, it has nothing to repeat.
    kinds = rows.assign(number=number).drop_duplicates("number")
    mates = kinds.groupby("bucket")["number"].transform("size").to_numpy()
    ranges: dict[int, list[tuple[int, int]]] = {}
    for i, w in zip(kinds["number"].to_numpy()[weight > 1].tolist(), kinds["windows"].to_numpy()[weight > 1].tolist()):
        ranges[i] = [(0, w + width - 1)]
    if (mates > 1).any():
        shared = kinds[mates > 1]
        words = [p.split(b" ") for p in shared["packed"]]
        ids = pd.factorize(np.array([w for text in words for w in text], dtype=object))[0]
        windows = shared["windows"].to_numpy()
        first = np.cumsum(windows + width - 1) - (windows + width - 1)
        owner = np.repeat(np.arange(len(shared)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        ranks = window_ranks(ids, width)[first[owner] + within]
        seen = np.bincount(ranks, weights=weight[shared["number"].to_numpy()][owner])[ranks] > 1
        edges = np.flatnonzero(seen[1:] & (~seen[:-1] | (owner[1:] != owner[:-1]))) + 1
        begins = np.concatenate([[0], edges]) if len(seen) and seen[0] else edges
        ends = np.flatnonzero(seen & np.append(~seen[1:] | (owner[1:] != owner[:-1]), True))
        numbers = shared["number"].to_numpy()
        found: dict[int, list[tuple[int, int]]] = {}
        for b, e in zip(begins.tolist(), ends.tolist()):
            found.setdefault(int(numbers[owner[b]]), []).append((int(within[b]), int(within[e]) + width))
        for i, spans in found.items():
            ranges.setdefault(i, spans)
    for tid, at, i in zip(rows["tid"].tolist(), rows["at"].tolist(), number.tolist()):
        for start, stop in ranges.get(i, ()):
            yield tid, at + start, at + stop


COUNTED = "tid bigint, start bigint, stop bigint, kind binary, packed binary, n bigint"


def _spans(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    found = pd.DataFrame(_repeated(rows.reset_index(drop=True), width), columns=["tid", "start", "stop"])
    return found.assign(kind=None, packed=None, n=None)


def _kinds(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of heavy buckets by kind, and every kind among them with the rows of the table that have it."""
    number, packed = pd.factorize(rows["packed"])
    kind = np.array([hashlib.sha256(p).digest() for p in packed], dtype=object)
    yield pd.DataFrame({"tid": rows["tid"].to_numpy(), "start": rows["at"].to_numpy(), "stop": None, "kind": kind[number], "packed": None, "n": None})
    n = np.bincount(number, weights=rows["n"].to_numpy()).astype(np.int64)
    yield pd.DataFrame({"tid": None, "start": None, "stop": None, "kind": kind, "packed": packed, "n": n})


def _count_buckets(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Counts whole buckets of rows that come sorted by bucket; rows of heavy ones are only told apart."""
    held: list[pd.DataFrame] = []
    words = 0
    for batch in batches:
        heavy = batch["heavy"].to_numpy()
        if heavy.any():
            yield from _kinds(batch[heavy])
            batch = batch[~heavy]
        if not len(batch):
            continue
        held.append(batch)
        words += int(batch["windows"].sum()) + (width - 1) * len(batch)
        if words < CHUNK:
            continue
        rows = pd.concat(held, ignore_index=True)
        open_bucket = rows["bucket"].to_numpy() == rows["bucket"].iat[-1]
        yield _spans(rows[~open_bucket], width)
        held = [rows[open_bucket]]
        words = int(held[0]["windows"].sum()) + (width - 1) * len(held[0])
    if held:
        yield _spans(pd.concat(held, ignore_index=True), width)


def _windows(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """The windows of super-k-mers one by one, by digest."""
    for batch in batches:
        rows = []
        for kind, n, packed in zip(batch["number"], batch["n"], batch["packed"]):
            words = packed.split(b" ")
            for i in range(len(words) - width + 1):
                rows.append((kind, i, n, hashlib.blake2b(b" ".join(words[i : i + width]), digest_size=16).digest()))
            if len(rows) > 50_000:
                yield pd.DataFrame(rows, columns=["number", "at", "n", "digest"])
                rows = []
        yield pd.DataFrame(rows, columns=["number", "at", "n", "digest"])


def lookup(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with a ``table`` of unique keys that knows how many rows each has.

    Keys of ``HOT`` rows and more, of which there are few, are joined apart, so that no task gets
    all rows of one.
    """
    hot = written(table.where(F.col(size) >= HOT))
    near = bounded(hot)
    if near is hot:
        much = salted_join(rows, hot, [key], [c for c in rows.columns if c != key])
    else:
        much = rows.join(near, key)
    rest = rows.join(bounded(hot.select(key)) if near is hot else near.select(key), key, "left_anti")
    return much.unionByName(rest.join(table.where(F.col(size) < HOT), key).select(much.columns))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``(tid, key, text, n)``: every text once, with the rows that have it; null is the empty text.

    Only texts that several rows have are shuffled, unless too many are for every task to know them.
    """
    text = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    keyed = text.select(F.unhex(F.sha2("text", 256)).alias("key"), "text")
    copied = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    near = bounded(copied)
    some = keyed if near is copied else keyed.join(near, "key", "left_semi")
    once = some.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    if near is not copied:
        once = once.unionByName(keyed.join(near, "key", "left_anti").withColumn("n", F.lit(1).cast("bigint")))
    texts = written(once.select(F.monotonically_increasing_id().alias("tid"), "key", "text", "n"))
    discard(copied)
    return texts


def repeated_spans(texts: DataFrame, width: int = WIDTH, core: int = CORE) -> DataFrame:
    """``(tid, spans)``: word ranges of ``texts`` covered by windows that start twice or more; several rows a text."""
    sizes = texts.mapInPandas(lambda b: _bucket_sizes(b, width, core), "bucket bigint, kmers bigint, n bigint")
    shared = written(sizes.groupBy("bucket").agg(F.sum("kmers").alias("kmers"), F.sum("n").alias("n")).where("n > 1"))
    heavy = written(shared.where(F.col("kmers") > HEAVY).select("bucket"))
    kept = texts.sparkSession.sparkContext.broadcast(bloom_of(shared, "bucket"))
    discard(shared)
    kmers = texts.mapInPandas(
        lambda b: _super_kmers(b, width, core, kept.value), "bucket bigint, tid bigint, at bigint, windows bigint, n bigint, packed binary"
    )
    # Rows of a heavy bucket are dealt by what they hold, so that equal ones still meet.
    marked = kmers.join(bounded(heavy.withColumn("heavy", F.lit(True))), "bucket", "left").withColumn("heavy", F.col("heavy").isNotNull())
    dealt = marked.withColumn("to", F.when(F.col("heavy"), F.xxhash64("packed", F.pmod("tid", F.lit(COPIES)))).otherwise(F.col("bucket")))
    ordered = dealt.repartition("to").sortWithinPartitions("heavy", "bucket").drop("to")
    counted = written(ordered.mapInPandas(lambda b: _count_buckets(b, width), COUNTED))
    found = counted.where("stop IS NOT NULL").select("tid", F.array(F.struct("start", "stop")).alias("spans"))
    kinds = (
        counted.where("packed IS NOT NULL").groupBy("kind").agg(F.first("packed").alias("packed"), F.sum("n").alias("n"))
        .withColumn("number", F.monotonically_increasing_id())
    )
    kinds = written(kinds)
    alone = written(kinds.mapInPandas(lambda b: _windows(b, width), "number bigint, at bigint, n bigint, digest binary"))
    seen = alone.groupBy("digest").agg(F.sum("n").alias("seen"), F.count("*").alias("_rows")).where("seen > 1").drop("seen")
    places = lookup(alone.select("number", "at", "digest"), written(seen), "digest", "_rows").groupBy("number").agg(F.collect_list("at").alias("places"))
    members = counted.where("kind IS NOT NULL AND packed IS NULL").select("tid", "start", "kind")
    sizes = members.groupBy("kind").agg(F.count("*").alias("_kmers"))
    repeats = written(kinds.join(places, "number").join(sizes, "kind").select("kind", "_kmers", "places"))
    more = lookup(members, repeats, "kind", "_kmers")
    span = F.transform("places", lambda i: F.struct((F.col("start") + i).alias("start"), (F.col("start") + i + width).alias("stop")))
    return found.union(more.select("tid", span.alias("spans")))


def _kept(batches: Iterator[pd.DataFrame], digest: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, spans in zip(batch["text"], batch["spans"]):
            words = split_words(text)
            total = len(words)
            merged: list[list[int]] = []
            for start, stop in sorted((s["start"], s["stop"]) for s in (spans if spans is not None else ())):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            for start, stop in reversed(merged):
                del words[start:stop]
            kept = b" ".join(words)
            out.append((total, total - len(words), [{"start": a, "stop": b} for a, b in merged], hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
        yield pd.DataFrame(out, columns=["n_words", "n_removed", "removed", "kept"]).assign(key=batch["key"].to_numpy(), n=batch["n"].to_numpy())


def remove_repeats(docs: DataFrame, width: int = WIDTH, core: int = CORE, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` without the words of any window that starts more than once in the table.

    Returns doc_id, n_words, n_removed, removed (word ranges, stop exclusive), kept (the other words
    joined by one space, or their SHA-256 in hex if ``digest``).  Windows are judged on the input;
    all their occurrences go, the first one too, within one text as well.

    Words are whole and unchanged (A and a differ).  A null, empty or blank text and one shorter than
    a window loses nothing.  Rows that repeat a text repeat its windows, whatever their doc_id; null
    ids are kept.  Other columns are ignored; an empty table gives no rows.
    """
    texts = distinct_texts(docs)
    spans = repeated_spans(texts, width, core).groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    schema = "n_words bigint, n_removed bigint, removed array<struct<start:bigint,stop:bigint>>, kept string, key binary, n bigint"
    done = written(texts.join(spans, "tid", "left").select("key", "text", "n", "spans").mapInPandas(lambda b: _kept(b, digest), schema))
    discard(texts)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key"))
    return lookup(rows, done, "key", "n").select("doc_id", "n_words", "n_removed", "removed", "kept")
