"""Personal data: patterns, and terms that give a person away by co-occurrence.

E-mail addresses, IP addresses, card numbers and phone numbers are found by
pattern. Each distinct value is a protected entity. For the terms in the texts
that hold it the corpus says how strongly they point to it: with p(e) the share of
texts with the entity and p(e|t) the share of the texts with a term that hold the
entity too, the term discloses the entity if

    log(p(e|t) / p(e)) >= ALPHA * -log(p(e))

that is, if its pointwise mutual information with the entity comes near the
information content of the entity. p(e|t) is smoothed by ``SMOOTH`` texts, so that
entities of one or two texts have disclosing terms as well. All occurrences of a disclosing term in the
documents with its entity are spans of kind ``term``, beside the spans of the
patterns.
``sanitised`` puts the name of the kind in place of a span (a generalisation)
or removes terms.

All of it is DataFrame functions. ``sanitised`` shuffles only texts with spans, or all
where the ids of those are too many to broadcast; the words of documents with
entities are shuffled. A frequent entity is counted per task before the shuffle, and a term is
paired with an entity only if it is rare enough to disclose it.

Patterns are written so that they need time in proportion to the text and no
recursion, also on very long runs of digits or letters.

Defined results: a null text is empty; equal rows get equal spans; overlapping
spans of different kinds are all reported, and covered once when replaced; an
empty table gives no rows. Ids must be unique and not null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import bounded, saved, without

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The match begins where a run of local characters begins or the last match ended.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
    r"[A-Za-z0-9.-]*?(?=\.?(?:[^A-Za-z0-9.-]|\z)|\.\.)"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Whole runs of digits with single separators that have 16 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}{3,}"
#: p(e|t) = (texts with both + SMOOTH) / (texts with t + 2 * SMOOTH)
SMOOTH = 0.5
ALPHA = 0.95


def matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern as array<struct<start, end, value>>, in code points."""
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    kind = "array<struct<start:int,end:int,value:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + F.coalesce(F.length(part["value"]), F.lit(0))
        own = F.struct(begin.alias("start"), end.alias("end"), part["value"].alias("value"))
        found = F.when(part["value"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(own))
        )
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(parts, start, step, lambda state: state["found"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octets(value: Column) -> Column:
    short = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(short, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), p).cast("int") <= 255))


def _luhn(value: Column) -> Column:
    digits = F.filter(F.split(F.reverse(_digits(value)), ""), lambda c: c != "")

    def counted(c: Column, i: Column) -> Column:
        n = c.cast("int")
        twice = 2 * n - F.when(n > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, twice).otherwise(n)

    return F.aggregate(F.transform(digits, counted), F.lit(0), lambda a, b: a + b) % 10 == 0


def _named(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            F.lit(kind).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
        ),
    )


def pattern_spans(text: Column) -> Column:
    """Spans of the four kinds, by kind as listed and then by start."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    digits = F.regexp_like(text, F.lit("[0-9]"))
    found = {
        "email": F.when(text.contains("@"), matches(text, EMAIL)).otherwise(none),
        "ip": F.when(F.regexp_like(text, F.lit(IP)), matches(text, IP)).otherwise(none),
        "card": F.when(
            digits & F.regexp_like(text, F.lit(CARD)),
            F.filter(matches(text, CARD), lambda s: _luhn(s["value"])),
        ).otherwise(none),
        "phone": F.when(
            text.contains("+"),
            F.filter(matches(text, PHONE), lambda s: F.length(_digits(s["value"])).between(8, 15)),
        ).otherwise(none),
    }
    found["ip"] = F.filter(found["ip"], lambda s: _octets(s["value"]))
    named = [_named(found[kind], kind) for kind in KINDS]
    return F.concat(*named)


def based(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id and the pattern spans."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select("id", pattern_spans(F.col("text")).alias("spans"))


def words_of(docs: DataFrame, base: DataFrame, key: str, text: str) -> DataFrame:
    """id, term, start and end of the words of documents with entities, outside the pattern spans."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(
        base.where(F.size("spans") > 0).select("id", "spans"), "id"
    )
    # the gap before each word; the ends are running sums, as a fold over a long text copies its state
    parts = F.arrays_zip(
        F.split("text", WORD, -1).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("value")
    )
    sizes = rows.select("id", F.posexplode(parts).alias("pos", "p")).where("p.value is not null")
    upto = F.sum(F.length("p.gap") + F.length("p.value")).over(Window.partitionBy("id").orderBy("pos"))
    found = sizes.select(
        "id", F.lower("p.value").alias("term"), upto.cast("int").alias("end"),
        (upto - F.length("p.value")).cast("int").alias("start"),
    )
    covered = F.exists("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    return found.join(base.select("id", "spans"), "id").where(~covered).select("id", "term", "start", "end")


def texts_with(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(term, n): how many texts hold each of some distinct terms.

    All terms are counted, in each task before the shuffle, and then picked: the terms
    of a task are far fewer than its words.
    """
    every = docs.select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))).alias("term")
    )
    return every.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")


def disclosing(docs: DataFrame, base: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """(id, term): the terms that give an entity of a document away."""
    entity = F.explode(
        F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    ).alias("entity")
    total = base.count()
    owned = saved(base.select("id", entity), "pii-owned")
    p_entity = F.col("texts") / F.lit(max(1, total))
    entities = owned.groupBy("entity").agg(F.count("*").alias("texts"))
    entities = entities.select(
        "entity", "texts",
        # the least share p(e|t) that discloses the entity
        F.pow(p_entity, F.lit(1 - ALPHA)).alias("least"),
    )
    held = saved(words.select("id", "term").distinct(), "pii-held")
    terms = saved(held.select("term").distinct(), "pii-terms")
    often = saved(texts_with(docs, terms, text), "pii-often")
    share = lambda n: (n + SMOOTH) / (F.col("n") + 2 * SMOOTH)
    pairs = (
        held.join(often, "term")
        .join(owned.join(entities, "entity"), "id")
        .where(share(F.col("texts")) >= F.col("least"))
        .select("id", "entity", "term", "n", "least")
    )
    pairs = saved(pairs, "pii-pairs")
    strong = (
        pairs.groupBy("entity", "term", "n", "least")
        .agg(F.count("*").alias("together"))
        .where(share(F.col("together")) >= F.col("least"))
        .select("entity", "term")
    )
    return pairs.join(strong, ["entity", "term"]).select("id", "term").distinct()


def all_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base and terms: arrays of struct<kind, start, end>, in order."""
    base = saved(based(docs, key, text), "pii-base")
    words = saved(words_of(docs, base, key, text), "pii-words")
    pairs = saved(disclosing(docs, base, words, text), "pii-disclosing")
    added = words.join(pairs, ["id", "term"]).groupBy("id").agg(
        F.array_sort(
            F.collect_set(F.struct(F.lit(TERM).alias("kind"), F.col("start"), F.col("end")))
        ).alias("terms")
    )  # bounded by the words of one text
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return base.join(added, "id", "left").select(
        F.col("id").alias(key), plain.alias("base"), F.coalesce("terms", none).alias("terms")
    )


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per kind, checksum of the pattern spans, and all spans as text."""
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        key,
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitised(
    docs: DataFrame, key: str = "doc_id", text: str = "text", remove_terms: bool = False
) -> DataFrame:
    """The documents, spans replaced by ``[kind]``; terms may be removed instead."""
    spans = saved(all_spans(docs, key, text), "pii-spans")
    some = spans.where((F.size("base") > 0) | (F.size("terms") > 0)).select(
        key, F.array_sort(
            F.transform(F.concat("base", "terms"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        ).alias("_spans"),
    )
    some = saved(some, "pii-some")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], state["at"])
        name = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        if remove_terms:
            name = F.when(s["kind"] == TERM, "").otherwise(name)
        gap = F.substring(F.col(text), state["at"] + 1, begin - state["at"])
        parts = F.when(s["start"] < state["at"], state["parts"]).otherwise(
            F.concat(state["parts"], F.array(gap, name))
        )
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), parts.alias("parts"))

    rest = lambda state: F.concat(
        F.concat_ws("", state["parts"]), F.substring(F.col(text), state["at"] + 1, F.length(text))
    )
    clean = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(
        F.aggregate("_spans", start, step, rest)
    )
    own = saved(some.select(key).distinct(), "pii-own")
    marked = docs.join(bounded(own), key, "left_semi").join(some, key, "left")
    return without(docs, own, key).unionByName(marked.withColumn(text, clean).select(docs.columns))
