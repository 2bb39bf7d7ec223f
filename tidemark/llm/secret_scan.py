"""Secret scans in DataFrame functions only: fixed patterns plus two Markov models of characters.

Base kinds (`assign`, `access`, `hex`) come from patterns. The kind `markov` is added by the
method: every other long run of key characters, of whatever characters, is scored under a first-order
Markov model of random strings and under one of ordinary identifiers, and counts as a secret when the
log-likelihood ratio passes a threshold that grows with the run's different transitions. Each of these
counts once, in training and scoring, so that a line of one sign or a repeated word isn't a long string; runs with
fewer than `MIN_STEPS` are none. Both models are trained from labelled samples: the values that the base patterns found are the random class, runs outside them
made of words and numbers the ordinary class, each distinct string once. A key of letters only is such a
run too: what is found in one sample only doesn't count, so it can't make itself ordinary. What the
values of a corpus never hold (letters beyond f, if all are hexadecimal) counts against a key.

Defined results: a null or empty text has no spans. Repeated rows and repeated ids are
scanned row by row. An empty table gives an empty result. Without any random sample the ratio
is zero for every string, so no `markov` span is added. Extra columns of the input,
whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

# Fixed values of the base patterns: kind, pattern, fewest characters.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
# At least 20 and 24 characters: a shorter greedy run fails as a whole, and holds no longer one.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

# Characters of keys; a character's place here is its state, the last state is the start.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
# Runs of at least MIN_SAMPLE characters train the models, those of MIN_RUN can be secrets.
MIN_SAMPLE = 12
MIN_RUN = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_SAMPLE},}}"
# Words, or numbers, with signs between them.
ORDINARY = r"^[/_-]*([A-Za-z]+|[0-9]+)([+/_=-]+([A-Za-z]+|[0-9]+))*[/=_-]*$"
# Least ratio of a run, whole and by transition: the small misfit of a long plain run adds up with its length.
MIN_LLR = 12.0
MIN_STEP_LLR = 0.5
# Different transitions that a secret has at least: a line of one sign or of a short pattern has fewer.
MIN_STEPS = 8
# Weight of the characters' frequencies against a state's own counts.
LEAN = 4.0

GROUP = 256

_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _found(text: str, pattern: str, rank: int) -> tuple[Column, Column]:
    """All leftmost non-overlapping matches, and their spans from the lengths of what lies between."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        steps = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("value"))
        groups = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(found) - 1) / GROUP).cast("int")),
            lambda g: F.slice(steps, g * GROUP + 1, F.lit(GROUP)),
        )

        def step(state: Column, piece: Column) -> Column:
            begin = state["at"] + F.length(piece["gap"])
            end = begin + F.length(piece["value"])
            span = F.struct(
                begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), piece["value"].alias("value")
            )
            return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        def add_group(done: Column, group: Column) -> Column:
            start = F.struct(done["at"].alias("at"), F.array().cast(_SPAN).alias("spans"))
            return F.aggregate(
                group,
                start,
                step,
                lambda state: F.struct(
                    state["at"].alias("at"), F.concat(done["spans"], F.array(state["spans"])).alias("spans")
                ),
            )

        # Appending copies an array, so spans are gathered in groups: a text may have very many.
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
        listed = F.aggregate(groups, start, add_group, lambda done: F.flatten(done["spans"]))
        return F.when(F.size(found) > 0, listed).otherwise(F.array().cast(_SPAN))

    return matches, spans


def _with_scan(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with `base`, the base spans that hold, and `runs` of key characters outside them.

    Offsets are code points, the end is exclusive. All columns of `docs` are put into `row`, so
    that no name can clash.
    """
    out = docs.select(F.struct("*").alias("row"), F.coalesce(text, F.lit("")).alias("_text"))
    for rank, (name, pattern) in enumerate((("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("run", RUN))):
        matches, spans = _found("_text", pattern, rank)
        out = out.withColumn(f"_{name}", matches).withColumn(f"_{name}", spans(F.col(f"_{name}")))
    value = F.regexp_extract
    held = F.filter("_assign", lambda s: F.length(value(s["value"], ASSIGN, 2)) >= ASSIGN_VALUE)
    out = out.withColumn("_assign", held)
    out = out.withColumn("base", F.concat("_assign", "_access", "_hex"))
    apart = F.filter(
        "_run",
        lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
    )
    return out.select("row", "base", apart.alias("runs"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, base, runs] of every row."""
    return _with_scan(docs.select(id_col, text_col), F.col(text_col)).select(F.col(f"row.{id_col}").alias("id"), "base", "runs")


def _samples(scanned: DataFrame) -> DataFrame:
    """[random, value]: each labelled string once."""
    values = scanned.select(F.explode("base").alias("s")).select(
        F.when(F.col("s.rank") == 0, F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value")).alias("value"),
        F.lit(True).alias("random"),
    )
    runs = scanned.select(F.explode("runs").alias("s")).select("s.value", F.lit(False).alias("random"))
    runs = runs.where(F.col("value").rlike(ORDINARY))
    return values.where(F.length("value") >= MIN_SAMPLE).unionByName(runs).distinct()


def _state(character: Column) -> Column:
    """Place of a character in ALPHABET; others share the place of the start."""
    place = F.instr(F.lit(ALPHABET), character)
    return F.when(place > 0, place - 1).otherwise(F.lit(STATES - 1))


def _transitions(characters: Column) -> Column:
    """Each step (a, b) from one state to the next that a string takes, once."""

    def step(c: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(STATES - 1)).otherwise(_state(F.get(characters, i - 1)))
        return F.struct(before.alias("a"), _state(c).alias("b"))

    return F.array_distinct(F.transform(characters, step))


def train(scanned: DataFrame) -> list[float]:
    """Log-ratio of the transition probabilities random / ordinary, by state * STATES + next state.

    The counts are summed on the executors; STATES * STATES values at most reach the driver.
    A transition counts once per sample, so that one long sample doesn't outweigh the others. Ordinary samples are runs that are scored themselves, so their
    counts are those of the other samples: a transition of a single one counts as not seen.
    """
    characters = _samples(scanned).select("random", F.split("value", "").alias("c"))
    steps = characters.select("random", F.explode(_transitions(F.col("c"))).alias("t"))
    counts = steps.groupBy("random", "t.a", "t.b").agg(F.count("*").alias("n"))
    found = counts.collect()
    if not any(row.random for row in found):
        return [0.0] * STATES**2
    table = {True: [0.0] * STATES**2, False: [0.0] * STATES**2}
    for row in found:
        table[row.random][row.a * STATES + row.b] = row.n if row.random else row.n - 1
    random, ordinary = (_log_probabilities(table[kind]) for kind in (True, False))
    return [r - o for r, o in zip(random, ordinary, strict=True)]


def _log_probabilities(counts: list[float]) -> list[float]:
    """Of all transitions; a state with few counts leans on the frequencies of the characters."""
    characters = [1 + sum(counts[b::STATES]) for b in range(STATES)]
    out = []
    for a in range(STATES):
        here = counts[a * STATES : (a + 1) * STATES]
        out += [
            math.log((n + LEAN * c / sum(characters)) / (sum(here) + LEAN)) for n, c in zip(here, characters, strict=True)
        ]
    return out


def log_likelihood_ratio(steps: Column, ratio: list[float]) -> Column:
    """Sum of the log-ratios of a string's transitions, each once, as the models count them."""
    table = F.array(*[F.lit(x) for x in ratio])
    return F.aggregate(steps, F.lit(0.0), lambda total, t: total + F.get(table, t["a"] * STATES + t["b"]))


def _spans(scanned: DataFrame, ratio: list[float], min_llr: float) -> DataFrame:
    """`scanned` with `spans` in place of `base` and `runs`."""
    def likely(run: Column) -> Column:
        # A loop over one element, so that the transitions are made once.
        own = F.array(_transitions(F.split(run["value"], "")))
        needed = lambda t: F.greatest(F.lit(min_llr), MIN_STEP_LLR * F.size(t))
        return F.exists(own, lambda t: (F.size(t) >= MIN_STEPS) & (log_likelihood_ratio(t, ratio) >= needed(t)))

    long_runs = F.filter("runs", lambda r: F.length(r["value"]) >= MIN_RUN)
    scored = scanned.withColumn("runs", long_runs).withColumn("runs", F.filter("runs", likely))
    every = F.array_sort(F.concat("base", "runs"))
    return scored.withColumn("spans", F.transform(every, lambda s: s.dropFields("value"))).drop("base", "runs")


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_llr: float = MIN_LLR
) -> DataFrame:
    """[id, spans]: spans(start, rank, end) ordered by start, then by kind.

    `rank` is the place in KINDS. The scanned spans, not the texts, are kept in the shared
    folder between the training and the scoring.
    """
    scanned = materialise(scan(docs, id_col, text_col), "secrets")
    return _spans(scanned, train(scanned), min_llr)


def redact_secrets(docs: DataFrame, text_col: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """`docs` with every secret in `text_col` replaced by a mark; the models are trained on them first."""
    scanned = _with_scan(docs, F.col(text_col))
    ratio = train(materialise(scanned.select("base", "runs"), "secrets"))
    found = _spans(scanned, ratio, min_llr)
    columns = [F.col("row").getField(c) for c in docs.columns]
    clean = {text_col: redact(F.col("row").getField(text_col), F.col("spans"))}
    return found.select(*[clean.get(c, column).alias(c) for c, column in zip(docs.columns, columns, strict=True)])


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with every span, or run of overlapping spans, replaced by `mark`."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"),
        )

    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
