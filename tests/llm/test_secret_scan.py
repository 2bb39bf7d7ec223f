"""Secret scans against a plain scan with Python's own patterns."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from tidemark.llm import queries, secret_scan

PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def plain(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if kind == "assign" and len(m.group(2)) < 6:
                continue
            if len(m.group()) < {"assign": 0, "access": 20, "hex": 24}[kind]:
                continue
            spans.append((m.start(), rank, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, rank, kind, end in sorted(spans)]


def write(spark, path, rows, schema="doc_id long, text string, spans string, id int, base string"):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def test_base_spans_and_the_model(spark, tmp_path):
    rng = random.Random(3)
    words = ["connection", "information", "international", "understanding", "misrepresentation"]
    texts = [
        None,
        "",
        "é ñ 😀 token = \"" + hexes(rng, 40) + "\" and " + hexes(rng, 24),
        "token=token:abcdefgh password: abc secret='abcdef' API_KEY=x.y-z+/=",
        "AKIA" + "Q7" * 8 + " AKIASHORT xAKIA" + "Z" * 16,
        hexes(rng, 23) + " " + hexes(rng, 24) + "g" + hexes(rng, 30),
        "key " + "-".join(hexes(rng, 8) for _ in range(4)) + " end",
        " ".join(rng.choice(words) + rng.choice(words) for _ in range(300)),
        "secret = " + "a" * 100_000,
        "".join(f"token = {hexes(rng, 24)} {'word' * 4}{k} " for k in range(3000)),
    ]
    texts += [f"token = {hexes(rng, 32)}" for _ in range(50)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    rows += [(2, texts[2], "x", 1, "y"), (None, texts[2], None, None, None)]
    got = queries.op7_secret_scan(spark, write(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(texts):
        want = plain(text)
        row = by_id[i]
        kept = [s for s in row.spans.split(",") if s and not s.startswith("markov")]
        assert kept == want
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert row[f"n_{kind}"] == sum(s.startswith(kind) for s in want)
    assert by_id[6].n_markov == 1 and by_id[7].n_markov == 0
    assert by_id[None].spans == by_id[2].spans


def plain_with_model(texts):
    """Base spans and those of the two models, counted and scored one string at a time."""
    alphabet, start = secret_scan.ALPHABET, len(secret_scan.ALPHABET)
    samples, runs, out = {True: set(), False: set()}, [], []
    for text in texts:
        base = []
        for rank, (kind, pattern) in enumerate(PATTERNS):
            for m in pattern.finditer(text):
                value = m.group(2) if kind == "assign" else m.group()
                if len(value) < {"assign": 6, "access": 20, "hex": 24}[kind]:
                    continue
                base.append((m.start(), rank, m.end(), kind))
                if len(value) >= 12:
                    samples[True].add(value)
        own = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{12,}", text)]
        own = [r for r in own if not any(b[0] < r[1] and r[0] < b[2] for b in base)]
        for _, _, value in own:
            pieces = re.split(r"[+/_=-]+", value.strip("/_-="))
            if value[0] not in "+=" and value[-1] != "+" and all(re.fullmatch("[A-Za-z]+|[0-9]+", p) for p in pieces):
                samples[False].add(value)
        runs.append(own)
        out.append(base)
    counts = {kind: [[0.0] * (start + 1) for _ in range(start + 1)] for kind in samples}
    steps = lambda v: list(zip([start, *(alphabet.find(c) % (start + 1) for c in v)], [alphabet.find(c) % (start + 1) for c in v]))  # noqa: E731, B905
    for kind, values in samples.items():
        for value in values:
            for a, b in set(steps(value)):
                counts[kind][a][b] += 1
    # A transition of one ordinary sample only counts as not seen.
    counts[False] = [[max(0.0, x - 1) for x in row] for row in counts[False]]
    log = {}
    for kind, table in counts.items():
        seen = [1 + sum(row[b] for row in table) for b in range(start + 1)]
        log[kind] = [
            [math.log((x + 4 * seen[b] / sum(seen)) / (sum(row) + 4)) for b, x in enumerate(row)] for row in table
        ]
    for base, own in zip(out, runs, strict=True):
        for begin, end, value in own:
            taken = set(steps(value))
            ratio = sum(log[True][a][b] - log[False][a][b] for a, b in taken)
            if len(value) >= 16 and len(taken) >= 8 and ratio >= max(12.0, 0.5 * len(taken)):
                base.append((begin, 3, end, "markov"))
    return [",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)) for spans in out]


def test_every_long_run_is_scored(spark, tmp_path):
    rng = random.Random(8)
    syllables = ["con", "nec", "tion", "in", "for", "ma", "ter", "na", "al", "un", "der", "stand", "ing", "re", "pre"]
    word = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    letters = ["".join(rng.choice(secret_scan.ALPHABET[:52]) for _ in range(40)) for _ in range(20)]
    mixed = ["".join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(40)) for _ in range(20)]
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [" ".join(word(rng.randint(4, 8)) for _ in range(30)) for _ in range(40)]
    texts += [f"at {key} end" for key in letters + mixed]
    texts += [f"token = {''.join(rng.choice(secret_scan.ALPHABET[:62]) for _ in range(40))}" for _ in range(400)]
    texts += [f"{number(16)} and {'-'.join(number(4) for _ in range(4))}" for _ in range(60)]
    texts += ["=" * 300, "z" * 5000, "/".join(["", *(word(3) for _ in range(5))]), "_".join(word(2) for _ in range(6)), "=" * 20 + "x" * 20]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in queries.op7_secret_scan(spark, write(spark, tmp_path, rows)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_with_model(texts)
    assert all(got[i] == "markov:3:43" for i in range(40, 80))
    assert all(got[i] == "" for i in [*range(40), *range(480, len(texts))])


def test_without_random_samples_no_ratio(spark, tmp_path):
    rows = [(1, "understanding information international connections", "x", 1, "y"), (2, "qZ" * 12 + "Xw" * 9, "x", 1, "y")]
    got = queries.op7_secret_scan(spark, write(spark, tmp_path, rows)).collect()
    assert all(r.spans == "" for r in got)


def test_without_samples_nothing_is_added(spark, tmp_path):
    rows = [(1, "Zx9" * 10, "x", 1, "y")]
    assert queries.op7_secret_scan(spark, write(spark, tmp_path / "a", rows)).first().spans == ""
    assert queries.op7_secret_scan(spark, write(spark, tmp_path / "b", [])).count() == 0


def test_redaction(spark):
    rows = spark.createDataFrame([(1, "é token = abcdef123 end"), (2, None)], "doc_id long, text string")
    found = secret_scan.find_secrets(rows)
    out = rows.join(found, rows.doc_id == found.id).select(
        "doc_id", secret_scan.redact(F.col("text"), F.col("spans")).alias("text")
    )
    assert dict(map(tuple, out.collect())) == {1: "é [SECRET] end", 2: None}


def test_native_plan(spark):
    rows = spark.createDataFrame([(1, "token = abcdef123")], "doc_id long, text string")
    plan = secret_scan.find_secrets(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
