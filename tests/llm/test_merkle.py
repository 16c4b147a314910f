import hashlib
import zlib

from pyspark.sql import functions as F

from ebbline.llm import merkle
from tests.llm.cases import SCHEMA, awkward, documents, empty


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """Levels of a tree over ``nodes``, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r.lang for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted(((r, leaf(r, r.text)) for r in rows if r.lang == g), key=lambda x: (first(x[0].doc_id), x[1])) for g in langs]
    trees = [tree([d for _, d in g]) for g in groups]
    above = tree([t[-1][0] for t in trees])
    out = []
    for g, (group, below) in enumerate(zip(groups, trees)):
        for i, (row, digest) in enumerate(group):
            path = [*steps(below, i), *steps(above, g)]
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
            now = leaf(row, lowered(row.text)) if hit else digest
            for left, right in path:
                now = h(*left, now, *right)
            proof = h(*[d for left, right in path for d in left + right])
            out.append((row.doc_id, digest, below[-1][0], above[-1][0], proof, now, now == above[-1][0]))
    return sorted(out, key=str)


def result(docs):
    found = merkle.checked(docs, merkle.tampered_ids())
    return sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def some(spark, sizes):
    rows = [(1_000 * k + i, f"Text {i} of {k}" if i % 3 else f"text {i}", None if k == 2 else f"l{k}", f"S{i % 4}", i) for k, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_same_as_plain_trees(spark):
    for sizes in ([1], [2], [8], [9], [1, 1], [3, 8, 9, 1, 64, 65, 2, 5, 17, 1], [700, 1, 73]):
        docs = some(spark, sizes).repartition(5)
        assert result(docs) == brute(docs.collect()), sizes


def test_given_documents(spark):
    docs = documents(spark)
    found = result(docs)
    assert found == brute(docs.collect())
    assert 0 < sum(not r[-1] for r in found) < len(found) / 2


def test_awkward_rows_and_many_copies(spark):
    docs = awkward(spark)
    assert result(docs) == brute(docs.collect())
    many = docs.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("i")
    assert result(many) == brute(many.collect())
    assert result(empty(spark)) == []


def test_paths_lead_to_the_root_and_hold_whole_runs(spark):
    rows = merkle.manifest(some(spark, [20, 70])).collect()
    assert len(rows) == 90 and len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 2
    for r in rows:
        assert r.claimed == r.leaf and r.path[0].run[r.path[0].at].hex() == r.leaf
        now = r.leaf
        for step in r.path:
            assert step.run[step.at].hex() == now
            now = h(*[bytes(d).hex() for d in step.run])
        assert now == r.root
