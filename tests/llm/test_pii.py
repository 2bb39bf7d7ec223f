"""Personal data against plain patterns, and the disclosure counts against a direct count."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import pii, queries

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), rank, m.end()))
    return sorted(spans)


def _write(spark, path, texts):
    rows = [(i, t, "x", 1, "y") for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, spans string, id int, word string").write.parquet(
        f"{path}/documents.parquet"
    )
    return str(path)


def test_base_spans_match_plain_patterns():
    rng = random.Random(5)
    parts = ["a.b", "@", "x-y.co", ".", "1.2.3.4", "256", "+1 (555) 123-4567", "4111 1111 1111 1111", "é", " ", "-", "+", "00012", "@@", "7"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("9" * 200_000 + "." * 1000) == []
    assert pii.base_spans("a" * 200_000 + "@" + "b" * 1000) == []


def _direct(texts):
    """Added spans of each text, counted directly."""
    words = [set(m.lower() for m in re.findall(r"[^\W\d_]{3,}", t or "")) for t in texts]
    near = [pii.beside(t or "", pii.base_spans(t or "")) for t in texts]
    n_word = Counter(w for ws in words for w in ws)
    both = Counter(x for rows in near for x in {(e, w) for e, w, *_ in rows})
    added = []
    for rows in near:
        own = defaultdict(list)
        for e, w, a, b in rows:
            if w == "" or both[e, w] < pii.MIN_DOCUMENTS:
                continue
            content = math.log(len(texts) / both[e, ""])
            share = math.log(both[e, w] * len(texts) / (n_word[w] * both[e, ""])) / content if content > 0 else 0
            if share >= pii.GENERALISE:
                own[a, b].append(4 if share >= pii.REMOVE else 5)
        added.append(sorted((a, min(k), b) for (a, b), k in own.items()))
    return added


def test_query(spark, tmp_path):
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda"]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(200)]
    texts += [f"{rng.choice(words)} surname zorro.z@mail.org {rng.choice(words)} zebulon sigma" for _ in range(6)]
    texts += ["zebulon alone here", None, "", "call +1 (555) 123-4567 now", "secretive " * 20_000 + "a@b.cd zorro"]
    got = queries.op8_disclosure(spark, _write(spark, tmp_path, [*enumerate(texts), (None, texts[-1])])).collect()
    assert len(got) == len(texts) + 1
    by_id = {r.doc_id: r for r in got}
    added = _direct([*texts, texts[-1]])
    names = pii.KINDS
    assert any(added)
    for i, text in enumerate(texts):
        base = plain(text)
        listed = [f"{names[k]}:{a}:{b}" for a, k, b in base]
        row = by_id[i]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert row.spans == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(base + added[i]))
        assert [row[f"n_{k}"] for k in names[:4]] == [sum(k2 == j for _, k2, _ in base) for j, k in enumerate(names[:4])]


def test_empty_table(spark, tmp_path):
    assert queries.op8_disclosure(spark, _write(spark, tmp_path, [])).count() == 0


def test_sanitised_text(spark):
    rows = [(i, "mister zorro a@b.cd met 1.2.3.4 há") for i in range(4)] + [(9 + i, f"no {i}") for i in range(20)]
    docs = spark.createDataFrame([*rows, (50, None)], "doc_id long, text string")
    found = pii.find_personal_data(docs)
    out = docs.join(found, docs.doc_id == found.id).select("doc_id", pii.sanitise(F.col("text"), F.col("spans")).alias("t"))
    text = dict(map(tuple, out.collect()))
    assert text[0] == "  [EMAIL]  [IP] há" and text[9] == "no 0" and text[50] is None


def test_rare_entities_on_the_supplied_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op8_disclosure(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(texts)
    for (i, text), added in zip(texts.items(), _direct(list(texts.values())), strict=True):
        spans = sorted(plain(text) + added)
        assert got[i].spans == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    assert sum(r.n_reveal for r in got.values()) > 0 and sum(r.n_hint for r in got.values()) > 0


def test_a_unique_name_far_from_its_entity(spark, tmp_path):
    filler = "common words here " * 100
    texts = [f"Zorro {filler} a@b.cd {filler} zorro", *[f"{filler} {i}" for i in range(50)]]
    got = {r.doc_id: r.spans for r in queries.op8_disclosure(spark, _write(spark, tmp_path, enumerate(texts))).collect()}
    n = len(texts[0])
    assert got[0].startswith("reveal:0:5,email:") and got[0].endswith(f"reveal:{n - 5}:{n}") and got[0].count("reveal") == 2
    assert not any(got[i] for i in range(1, 51))
