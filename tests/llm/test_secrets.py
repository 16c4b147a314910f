import hashlib
import random
import string

from ebbline.llm import secrets
from tests.llm.cases import awkward, empty, SCHEMA

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def scan(text):
    """The base kinds, character by character."""
    out, i = [], 0
    while i < len(text):
        name = next((n for n in NAMES if all(c in (d, d.upper()) for c, d in zip(text[i : i + len(n)], n)) and len(text[i : i + len(n)]) == len(n)), None)
        j = i + len(name or "")
        if name:
            j += text[j : j + 1] in ('"', "'") and text[j : j + 1] != ""
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in (":", "=") and j < len(text):
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ('"', "'") and text[j : j + 1] != ""
                k = j
                while k < len(text) and text[k] in VALUE:
                    k += 1
                if k > j:
                    out += [(i, 0, k)] * (k - j >= 8)
                    i = k
                    continue
        i += 1
    for kind, start, chars, least in ((1, "AKIA", string.ascii_uppercase + string.digits, 16), (2, "", "0123456789abcdef", 32)):
        i = 0
        while i < len(text):
            if text.startswith(start, i):
                k = i + len(start)
                while k < len(text) and text[k] in chars:
                    k += 1
                if k > i + len(start):
                    out += [(i, kind, k)] * (k - i >= least)
                    i = k
                    continue
            i += 1
    return sorted(out)


def made(seed, n=300):
    rng = random.Random(seed)
    parts = [*NAMES, "Password", "TOKEN", "ſecret", "AKIA", "AKIA" + "Q" * 16, ":", "=", " ", "  ", '"', "'", "a1B2c3D4", "deadbeef" * 4, "x", ".", "é", "\n"]
    return ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]


def test_base_spans(spark):
    texts = made(1)
    rows = secrets.secrets(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = scan(texts[r.doc_id])
        base = secrets.joined(want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x[1] for x in want) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))


def test_ownership_separates_copies_from_live_values(spark):
    copied, own = "Zx9Kq2Lm8Np4Rt6Vw3Yb7Hd5", "Qw8Er7Ty6Ui5Op4As3Df2Gh1"
    rows = [(i, f"see {copied} here", "en", f"s{i}", 0) for i in range(4)] + [(9, f"mine {own} and {copied}", "en", "s9", 0), (10, f"again {own}", "en", "s9", 0)]
    got = {r.doc_id: r for r in secrets.secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0].spans == "" and got[0].n_copied == 1
    assert got[9].spans == "token:5:29" and got[9].n_live == 1 and got[10].spans == "token:6:30"


def test_owners_and_repositories_both_count(spark):
    value = "Zx9Kq2Lm8Np4Rt6Vw3Yb7Hd5"
    rows = [(i, f"see {value} {i}", "en", f"s{i}", 0) for i in range(4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.n_live for r in secrets.secrets(docs, repository="lang").collect()} == {1}  # one repository
    assert {r.n_live for r in secrets.secrets(docs, owner="lang").collect()} == {1}  # one owner
    assert {r.n_copied for r in secrets.secrets(docs).collect()} == {1}


def test_hot_values_get_the_same_verdicts(spark):
    rng = random.Random(8)
    values = ["".join(rng.choices(string.ascii_letters + string.digits, k=30)) + "aB3" for _ in range(6)]
    rows = [(i, f"{rng.choice(values[: 1 + i % 6])} and {rng.choice(values)}", "en", f"s{i % (1 + i % 5)}", 0) for i in range(60)]
    scanned = secrets.scan(spark.createDataFrame(rows, SCHEMA))
    known = secrets.ownership(scanned)
    each = scanned.selectExpr("row", "explode(found) AS x").selectExpr("row", "x.hash AS hash")
    verdicts = [sorted(secrets._judged(each, known, hot).select("row", "hash", "copied").collect()) for hot in (1, 20, 10_000)]
    assert verdicts[0] == verdicts[1] == verdicts[2] and len(verdicts[0]) == 120


def test_further_spans_leave_taken_ones_alone():
    texts = made(2) + ["token=" + v + " " + v for v in ("ghp_" + "a1B2" * 12, "AIza" + "x9Y" * 11 + "zz")] + ["aB3" * 9 + " "] * 3
    found = 0
    for text in (*texts, " ".join(texts)):
        base = secrets.base_spans(text)
        more = secrets.more_spans(text, base)
        taken = [(a, b) for a, _, b, _ in base]
        want = []
        for name, pattern in secrets._MORE.items():
            for m in pattern.finditer(text):
                if (name != "token" or secrets._MIXED.match(m[0])) and all(m.end() <= a or b <= m.start() for a, b in taken):
                    want.append((m.start(), secrets.KINDS.index(name), m.end(), m[0]))
                    taken.append(m.span())
        assert more == want
        found += len(more)
    assert found > 5


def test_awkward_rows(spark):
    rows = secrets.secrets(awkward(spark)).collect()
    assert len(rows) == 11 and {r.spans for r in rows} == {""}
    assert secrets.secrets(empty(spark)).count() == 0
