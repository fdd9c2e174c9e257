"""Personal data: fixed patterns, and identifiers found by their context.

Base kinds are email, ip, card and phone. Their matches are the seeds of a bootstrap: a seed's
value is an instance; a neighbouring word together with the value's shape (letter runs, single
digits, punctuation) is a lexical pattern. Instances and patterns form a graph over all documents.
A pattern's confidence in a kind is the mean score of the distinct instances it holds, an
instance's score is the best confidence of its patterns, and seeds keep score one. After some rounds,
instances that are no seeds and score high enough are personal data of kind ``ctx_<kind>`` wherever
they stand. Neighbouring words are whole, however long they are.

Null or empty text has no spans. Ties between kinds go to the alphabetically first. Repeated rows
each get the same spans. Result columns replace same-named columns of the input.

Only DataFrame expressions are used. The patterns below start where a run of their characters
starts, so that a long run is not tried again from each of its characters; the matches are those
of the plain patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.spans import gated, match_spans
from shelfwise.sources.scratch import materialise

KINDS = ("email", "ip", "card", "phone")
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: A word that holds a digit or an at sign.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
EDGES = r"""[.,;:!?()\[\]{}<>"']+"""
#: How far to look for the word beside a place; only longer words are looked for farther off.
CONTEXT_CHARS = (64, 1 << 10, 1 << 14)


@dataclass(frozen=True)
class PiiParams:
    rounds: int = 3
    min_support: float = 3.0
    min_confidence: float = 0.6
    min_length: int = 6
    min_digits: int = 4
    broadcast_rows: int = 250_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """The check sum of card numbers; ``value`` must be cheap to evaluate."""
    reversed_digits = F.split(F.reverse(_digits(value)), "(?!^)(?!$)")
    doubled = F.transform(
        reversed_digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Per base kind the checked matches, by start."""
    n_digits = lambda s: F.length(_digits(s["value"]))
    email = gated(text.contains("@"), match_spans(text, EMAIL))
    ip = gated(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), match_spans(text, IP))
    card = gated(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), match_spans(text, CARD))
    phone = gated(text.rlike(r"\+[0-9]"), match_spans(text, PHONE))
    return {
        "email": email,
        "ip": F.filter(ip, lambda s: s["value"].rlike(OCTETS)),
        "card": F.filter(card, lambda s: _luhn(s["value"])),
        "phone": F.filter(phone, lambda s: n_digits(s).between(8, 15)),
    }


def _candidates(text: Column, params: PiiParams) -> Column:
    """Words that may be identifiers, without punctuation around them."""
    words = gated(text.rlike("[0-9@]"), match_spans(text, TOKEN))

    def trimmed(s):
        lead = F.length(F.regexp_extract(s["value"], f"^{EDGES}", 0))
        tail = F.length(F.regexp_extract(s["value"], f"{EDGES}$", 0))
        bare = F.regexp_replace(F.regexp_replace(s["value"], f"^{EDGES}", ""), f"{EDGES}$", "")
        return F.struct(
            (s["start"] + lead).alias("start"), (s["end"] - tail).alias("end"), bare.alias("value")
        )

    likely = lambda s: (F.length(s["value"]) >= params.min_length) & (
        s["value"].contains("@") | (F.length(_digits(s["value"])) >= params.min_digits)
    )
    return F.filter(F.transform(words, trimmed), likely)


def tag_base(docs: DataFrame, params: PiiParams, text: str = "text") -> DataFrame:
    """One row per document: a key of the row, base spans by kind, and candidate words.

    The key is a hash of id and text: rows that share it have the same spans.
    """
    columns = base_spans(F.col(text))
    tagged = docs.select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("row_key"),
        *[spans.alias(kind) for kind, spans in columns.items()],
        _with_context(_candidates(F.col(text), params), F.col(text)).alias("candidates"),
        F.col(text).alias("_text"),
    )
    contexts = [_with_context(F.col(kind), F.col("_text")).alias(kind) for kind in KINDS]
    return tagged.select("doc_id", "row_key", *contexts, "candidates")


def _widening(windows: list[tuple[Column, Column]]) -> Column:
    """Of words and whether they are whole the first whole one, else the last."""
    *narrow, (last, _) = windows
    found = last
    for word, whole in reversed(narrow):
        found = F.when(whole, word).otherwise(found)
    return F.lower(found)


def _with_context(spans: Column, text: Column) -> Column:
    """Adds the word before and the word after, lower-cased and whole."""

    def before(s, chars: int | None):
        begin = F.greatest(s["start"] - chars, F.lit(0)) if chars else F.lit(0)
        part = F.substring(text, begin + 1, s["start"] - begin)
        whole = (begin == 0) | part.rlike(r"\s\S++\s*+$")
        return F.regexp_extract(part, r"(?<!\S)(\S++)\s*+$", 1), whole

    def after(s, chars: int | None):
        part = F.substring(text, s["end"] + 1, F.lit(chars or (1 << 31) - 1))
        whole = (F.length(part) < chars) | part.rlike(r"^\s*+\S++\s") if chars else F.lit(True)
        return F.regexp_extract(part, r"^\s*+(\S++)", 1), whole

    def words(s):
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            _widening([before(s, chars) for chars in (*CONTEXT_CHARS, None)]).alias("before"),
            _widening([after(s, chars) for chars in (*CONTEXT_CHARS, None)]).alias("after"),
        )

    return F.transform(spans, words)


def _occurrences(base: DataFrame) -> DataFrame:
    """(row_key, start, end, instance, shape, before, after, kind); kind is null off the seeds."""
    fields = ["s.start", "s.end", "s.value", "s.before", "s.after"]
    seeds = [
        base.select("row_key", F.explode(kind).alias("s")).select(
            "row_key", *fields, F.lit(kind).alias("kind")
        )
        for kind in KINDS
    ]
    inside = F.exists(
        F.concat(*[F.col(k) for k in KINDS]),
        lambda b: (b["start"] < F.col("s.end")) & (b["end"] > F.col("s.start")),
    )
    unseen = (
        base.select("row_key", *KINDS, F.explode("candidates").alias("s"))
        .filter(~inside)
        .select("row_key", *fields, F.lit(None).cast("string").alias("kind"))
    )
    every = unseen
    for rows in seeds:
        every = every.unionByName(rows)
    shape = F.regexp_replace(F.regexp_replace("value", r"\p{L}+", "a"), "[0-9]", "9")
    return every.select(
        "row_key",
        "start",
        "end",
        F.lower("value").alias("instance"),
        shape.alias("shape"),
        "before",
        "after",
        "kind",
    )


def score_graph(occurrences: DataFrame, params: PiiParams) -> DataFrame:
    """(instance, kind, score) of instances off the seeds that reach ``min_confidence``."""
    sides = F.array(
        F.struct(F.lit("<").alias("side"), F.col("before").alias("word")),
        F.struct(F.lit(">").alias("side"), F.col("after").alias("word")),
    )
    edges = occurrences.select("instance", "shape", F.explode(sides).alias("c")).filter(
        F.col("c.word") != ""
    )
    pattern = F.xxhash64("c.side", "c.word", "shape").alias("pattern")
    edges = materialise(edges.select("instance", pattern).distinct(), "pii-edges")
    seeds = materialise(
        occurrences.filter(F.col("kind").isNotNull())
        .select("instance", "kind", F.lit(1.0).alias("score"))
        .distinct(),
        "pii-seeds",
    )
    sizes = materialise(edges.groupBy("pattern").agg(F.count("*").alias("size")), "pii-sizes")
    scores = seeds
    for turn in range(params.rounds):
        mass = edges.join(scores, "instance").groupBy("pattern", "kind")
        trusted = materialise(
            mass.agg(F.sum("score").alias("mass"))
            .filter(F.col("mass") >= params.min_support)
            .join(sizes, "pattern")
            .select("pattern", "kind", (F.col("mass") / F.col("size")).alias("confidence"))
            .filter(F.col("confidence") >= params.min_confidence),
            f"pii-patterns-{turn}",
        )
        found = edges.join(trusted, "pattern").groupBy("instance", "kind")
        unseen = found.agg(F.max("confidence").alias("score")).join(
            seeds.select("instance"), "instance", "left_anti"
        )
        scores = materialise(seeds.unionByName(unseen), f"pii-scores-{turn}")
    best = scores.join(seeds.select("instance"), "instance", "left_anti").groupBy("instance")
    pick = F.min(F.struct((-F.col("score")).alias("s"), F.col("kind").alias("kind")))
    return best.agg(pick.alias("b")).select(
        "instance", F.col("b.kind").alias("kind"), (-F.col("b.s")).alias("score")
    )


def find_spans(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """One row per document: doc_id, row_key, base spans by kind, and ``found``.

    ``found`` holds (kind, start, end) of identifiers found by context, by kind and start.
    """
    params = params or PiiParams()
    base = materialise(tag_base(docs, params), "pii-base")
    occurrences = materialise(_occurrences(base), "pii-occurrences")
    discovered = materialise(score_graph(occurrences, params), "pii-discovered")
    span = F.struct(F.concat(F.lit("ctx_"), "kind").alias("kind"), "start", "end")
    places = occurrences.filter(F.col("kind").isNull()).select(
        "row_key", "instance", "start", "end"
    )
    found = (
        places.join(discovered, "instance")
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_set(span)).alias("found"))
    )
    kinds = [F.transform(k, lambda s: F.struct(s["start"], s["end"])).alias(k) for k in KINDS]
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return base.select("doc_id", "row_key", *kinds).join(found, "row_key", "left").withColumn(
        "found", F.coalesce("found", none)
    )


def all_spans(found: DataFrame) -> Column:
    """Base spans by kind as listed, then those found by context: (kind, start, end)."""
    typed = "array<struct<kind:string,start:int,end:int>>"

    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind), s["start"], s["end"])).cast(typed)

    return F.concat(*[named(kind) for kind in KINDS], F.col("found").cast(typed))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[KIND]``; overlapping spans become one."""
    found = find_spans(docs, params)
    spans = F.array_sort(
        F.transform(all_spans(found), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    marked = (
        found.select("row_key", spans.alias("_spans"))
        .filter(F.size("_spans") > 0)
        .dropDuplicates(["row_key"])
    )
    marked = materialise(marked, "pii-marked")
    if marked.count() <= (params or PiiParams()).broadcast_rows:
        marked = F.broadcast(marked)  # beyond that the texts are shuffled
    # As one column, the given ones meet no name used here.
    joined = docs.select(
        F.struct(*docs.columns).alias("_in"), F.xxhash64("doc_id", "text").alias("row_key")
    ).join(marked, "row_key", "left")
    text = F.col("_in")["text"]

    def step(done, s):
        label = F.upper(F.regexp_replace(s["kind"], "^ctx_", ""))
        clean = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        out = F.when(
            s["start"] >= done["at"], F.concat(done["out"], clean, F.lit("["), label, F.lit("]"))
        ).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.length(text))
    )
    clean = F.when(F.col("_spans").isNull(), text).otherwise(
        F.aggregate("_spans", begin, step, rest)
    )
    columns = [clean if c == "text" else F.col("_in")[c] for c in docs.columns]
    return joined.select(*[v.alias(c) for v, c in zip(columns, docs.columns, strict=True)])
