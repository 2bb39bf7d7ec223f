"""Personal data: fixed patterns plus information-theoretic sanitisation of the words around them.

Patterns find the protected entities (`email`, `ip`, `card`, `phone`). A word in a document of an entity
reveals it as far as the corpus says so: with document counts n over all N documents, the
pointwise mutual information log(n(word, entity) N / (n(word) n(entity))) is compared with
the information content log(N / n(entity)) of the entity. From `REMOVE` of that content on a
word nearly names the entity and is removed, from `GENERALISE` on it narrows it down
and is generalised. Such words are spans of the kinds `reveal` and `hint`, wherever they are in the entity's documents.

All entities count, those of one document too: a word that only this document has names them as surely as
the corpus can say. Counts aren't smoothed. A word of n(word) documents can only be telling for an entity if it would be
with n(word, entity) = min(n(word), n(entity)), so other pairs are never formed; entities of the same documents are
one (by a 128-bit hash of the documents).

Defined results: a null or empty text has no spans; repeated rows are separate documents, as
are rows with equal or null ids; an empty table gives an empty result. Extra columns of the
input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

KINDS = ("email", "ip", "card", "phone", "reveal", "hint")
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "", "[WORD]")

# Documents that hold a word and an entity from which the pair counts: every pair does.
MIN_DOCUMENTS = 1
REMOVE, GENERALISE = 0.95, 0.75

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digit runs are taken whole and from their start, so that long ones cost one pass.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of the matches that hold, ordered."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def entities_of(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """Entity of each span."""
    out = []
    for start, kind, end in spans:
        value = text[start:end].lower()
        out.append(f"{KINDS[kind]}:{value if kind == 0 else re.sub(r'[^0-9.]', '', value)}")
    return out


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of the words in no span; `spans` are ordered."""
    i, done = 0, 0
    for m in _TERM.finditer(text):
        # `done` is the furthest end of the spans that begin before the word ends.
        while i < len(spans) and spans[i][0] < m.end():
            done = max(done, spans[i][2])
            i += 1
        if m.start() >= done:
            yield m.group().lower(), m.start(), m.end()


def beside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, word, start, end) of the words in no span, for each span.

    The pairs that count, listed in full; the query never forms them all.
    """
    words, out = list(words_outside(text, spans)), []
    for (start, _, _), entity in zip(spans, entities_of(text, spans), strict=True):
        # The entity itself, under the empty word, counts its documents.
        out.append((entity, "", start, start))
        out += [(entity, *word) for word in words]
    return out


_SPANS = "array<struct<start:int,rank:int,end:int>>"
_SPANS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))


def _listed(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"start": a, "rank": k, "end": b} for a, k, b in spans]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, spans, entities, words, held]: base spans of every row; of rows with any, also the entities and words, each once, and the text."""
    strings = pa.list_(pa.string())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            spans, entities, words, held = [], [], [], []
            for text in rows.column(1):
                text = text.as_py() or ""
                found = base_spans(text)
                spans.append(_listed(found))
                entities.append(sorted(set(entities_of(text, found))))
                words.append(sorted({w for w, _, _ in words_outside(text, found)}) if found else [])
                held.append(text if found else None)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(spans, _SPANS_TYPE),
                    pa.array(entities, strings),
                    pa.array(words, strings),
                    pa.array(held, pa.string()),
                ],
                names=["id", "spans", "entities", "words", "held"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, f"id long, spans {_SPANS}, entities array<string>, words array<string>, held string")


class _Terms(dict):
    """The words in a run without blanks, lower-cased."""

    def __missing__(self, run: str) -> tuple[str, ...]:
        terms = self[run] = tuple(m.lower() for m in _TERM.findall(run))
        return terms


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """[word, n]: number of documents that hold each word, over all documents.

    Counts are summed per batch before they are exchanged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            terms, counts = _Terms(), Counter()
            for text in rows.column(0):
                runs = set((text.as_py() or "").split())
                counts.update({t for run in runs for t in terms[run]})
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())}
            )

    per_batch = docs.select(F.col(text_col)).mapInArrow(count, "word string, n long")
    return per_batch.groupBy("word").agg(F.sum("n").alias("n_word"))


def _disclosed(n_both: Column, n_word: Column, n_entity: Column, n_all: int) -> Column:
    """Rank of a word for an entity by their counts, null for a word that isn't telling."""
    content = F.log(F.lit(float(n_all)) / n_entity)
    information = F.log(n_both * F.lit(float(n_all)) / (n_word * n_entity))
    # An entity of every document has no content that a word could disclose.
    share = F.when(content > 0, information / content)
    return F.when(share >= REMOVE, KINDS.index("reveal")).when(share >= GENERALISE, KINDS.index("hint"))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every occurrence of the telling words of each row, beside its base spans."""
    for rows in batches:
        ids, base, texts, telling = (rows.column(i).to_pylist() for i in range(4))
        every = []
        for spans, text, words in zip(base, texts, telling, strict=True):
            if words:
                ranks = {w["word"]: w["rank"] for w in words}
                known = [(s["start"], s["rank"], s["end"]) for s in spans]
                added = [(a, ranks[w], b) for w, a, b in words_outside(text, known) if w in ranks]
                spans = _listed(sorted(known + added))
            every.append(spans)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(every, _SPANS_TYPE)], names=["id", "spans"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, spans]: base and added spans(start, rank, end), ordered; `rank` is the place in KINDS."""
    found = scan(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    found = materialise(found, "pii-spans")
    n_all = found.count()
    holding = found.where(F.size("entities") > 0)
    held = holding.select("uid", F.explode("entities").alias("entity"))
    # Entities of the same documents have the same counts with every word.
    same = [F.bit_xor(F.xxhash64("uid", F.lit(i))).alias(f"same{i}") for i in range(2)]
    sets = held.groupBy("entity").agg(F.count("*").alias("n_entity"), *same)
    group = ["n_entity", "same0", "same1"]
    groups = held.join(sets, "entity").select("uid", *group).distinct()
    words = holding.select("uid", F.explode("words").alias("word")).join(document_counts(docs, text_col), "word")
    at_most = F.least("n_word", "n_entity")
    pairs = groups.join(words, "uid").where(_disclosed(at_most, F.col("n_word"), F.col("n_entity"), n_all).isNotNull())
    pairs = materialise(pairs, "pii-pairs")
    counts = pairs.groupBy(*group, "word", "n_word").agg(F.count("*").alias("n_both"))
    rank = _disclosed(F.col("n_both"), F.col("n_word"), F.col("n_entity"), n_all)
    known = counts.where(F.col("n_both") >= MIN_DOCUMENTS).withColumn("rank", rank).where(F.col("rank").isNotNull())
    # A word in the documents of two entities takes the stronger of its two kinds.
    telling = pairs.join(known.select(*group, "word", "rank"), [*group, "word"]).groupBy("uid", "word").agg(F.min("rank").alias("rank"))
    listed = telling.groupBy("uid").agg(F.collect_list(F.struct("word", "rank")).alias("telling"))
    plain = found.where(F.size("entities") == 0).select("id", "spans")
    marked = holding.select("uid", "id", "spans", "held").join(listed, "uid", "left").select("id", "spans", "held", "telling")
    return plain.unionByName(marked.mapInArrow(_mark, f"id long, spans {_SPANS}"))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def sanitise(text: Column, spans: Column) -> Column:
    """`text` with each span, the first of overlapping ones, replaced by the mark of its kind."""
    marks = F.array(*[F.lit(m) for m in MARKS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        piece = F.concat(state["out"], between, F.get(marks, span["rank"]))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], piece).otherwise(state["out"]).alias("out"),
        )

    def rest(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
