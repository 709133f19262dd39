"""Secrets found through a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression together with the literal alternatives it
must contain (lower-cased). From these comes its Boolean trigram query: an OR,
over the alternatives, of the AND of each alternative's trigrams. Rules whose
alternatives are unknown (``hex``) have no mandatory trigram and scan every
text.

1. Postings: one scan of the texts, A-Z lower-cased, lists the distinct query
   trigrams of each text (a look-ahead pattern finds overlapping ones) and
   explodes them to (text, trigram) rows: the inverted index of the trigrams
   that some query asks for.
2. Intersection: postings joined with the (rule, alternative, trigram) table
   and counted per text and alternative; a text whose count reaches the
   alternative's number of trigrams is a candidate of the rule.
3. Verification: the rule's pattern runs on the candidates only. Matches are
   leftmost and non-overlapping (Java's regex); positions come from the pieces
   between them (``split``) by a running sum, so a text with many matches
   costs linear time. Matches failing the rule's length are dropped; the
   search goes on after them (no retries).

The base rules (fixed values of the contract):

* assign: ``(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)``,
  letters of the first group in either case, group 2 of 8 or more characters;
* access: ``AKIA[A-Z0-9]+``, 16 or more characters;
* hex: ``[0-9a-f]+``, 32 or more characters.

For access and hex, the pattern with the length as a count (``AKIA[A-Z0-9]{12,}``,
``[0-9a-f]{32,}``) finds exactly the kept matches: a failing match is a whole
maximal run, and no later start inside it can be longer. For assign a failing
group 2 may hide a later match, so the base pattern runs and group 2 is
measured.

Spans: ``kind:start:end`` in code points, end exclusive, ordered by start and
then kind as listed, comma-joined; base_sha256 is the SHA-256 of that text.
The index only narrows the texts that are read, so ``spans`` holds the same
spans as the base.

Defined results: a null text is empty and has no spans; a text without spans
gives zero counts and the hash of the empty string; rows with equal doc_id and
text give one result row each, with equal values; rows with a null doc_id are
kept with a null doc_id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import discard, saved

# Fixed values of the contract: keywords, classes and lengths of the rules.
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN_TAIL = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS_PREFIX, ACCESS_CLASS, ACCESS_LEAST = "AKIA", "[A-Z0-9]", 16
HEX_CLASS, HEX_LEAST, ASSIGN_LEAST = "[0-9a-f]", 32, 8
KINDS = ["assign", "access", "hex"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def either_case(word: str) -> str:
    """A pattern for an ASCII word whose letters may have either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join(either_case(k) for k in KEYWORDS) + ")" + ASSIGN_TAIL
ACCESS_BASE = ACCESS_PREFIX + ACCESS_CLASS + "+"
ACCESS = ACCESS_PREFIX + ACCESS_CLASS + "{%d,}" % (ACCESS_LEAST - len(ACCESS_PREFIX))
HEX_BASE = HEX_CLASS + "+"
HEX = HEX_CLASS + "{%d,}" % HEX_LEAST


def alternatives(pattern: str) -> list[str]:
    """Literal forms of a keyword pattern whose only operator is an optional `_`."""
    return [pattern.replace("_?", "_"), pattern.replace("_?", "")] if "_?" in pattern else [pattern]


#: kind -> the lower-cased literals of which every match contains one; None: scan all.
LITERALS = {
    "assign": [form for k in KEYWORDS for form in alternatives(k)],
    "access": [ACCESS_PREFIX.lower()],
    "hex": None,
}


def trigrams(word: str) -> list[str]:
    return sorted({word[i : i + 3] for i in range(len(word) - 2)})


def queries() -> list[tuple[str, int, str, int]]:
    """(kind, alternative, trigram, trigrams of the alternative) of every rule with literals."""
    rows = []
    for kind, literals in LITERALS.items():
        for k, literal in enumerate(literals or []):
            grams = trigrams(literal)
            rows += [(kind, k, g, len(grams)) for g in grams]
    return rows


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.hash(text).alias("h2")).alias("key"),
    )


def postings(docs: DataFrame) -> DataFrame:
    """(key, trigram): each distinct trigram of a text that a rule's query names."""
    grams = sorted({g for _, _, g, _ in queries()})
    ahead = "(?=(" + "|".join(grams) + "))"
    low = F.translate("text", UPPER, LOWER)
    return docs.select("key", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(ahead), 1))).alias("trigram"))


def candidates(docs: DataFrame) -> DataFrame:
    """(key, kind): texts that satisfy a rule's trigram query."""
    spark = docs.sparkSession
    table = spark.createDataFrame(queries(), "kind string, alternative int, trigram string, need int")
    return (
        postings(docs)
        .join(F.broadcast(table), "trigram")
        .groupBy("key", "kind", "alternative")
        .agg(F.count_distinct("trigram").alias("have"), F.first("need").alias("need"))
        .where(F.col("have") == F.col("need"))
        .select("key", "kind")
        .distinct()
    )


def _pieces(docs: DataFrame, kind: str, pattern: str, group: int, least: int) -> DataFrame:
    """(key, kind, pos, before, width, kept): matches with the text before them."""
    p = F.lit(pattern)
    parts = F.arrays_zip(
        F.split("text", pattern, -1).alias("before"),
        F.regexp_extract_all("text", p, 0).alias("match"),
        F.regexp_extract_all("text", p, group).alias("part"),
    )
    return (
        docs.select("key", F.posexplode(parts).alias("pos", "m"))
        .where(F.col("m.match").isNotNull())
        .select(
            "key", F.lit(kind).alias("kind"), "pos",
            F.length("m.before").alias("before"), F.length("m.match").alias("width"),
            (F.length("m.part") >= least).alias("kept"),
        )
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end) of every kept match, read through the index."""
    keyed = _keyed(docs)
    chosen = saved(candidates(keyed), "secrets-candidates")
    found = []
    for kind, pattern, group, least in (("assign", ASSIGN, 2, ASSIGN_LEAST), ("access", ACCESS, 0, ACCESS_LEAST)):
        texts = keyed.join(chosen.where(F.col("kind") == kind).select("key"), "key", "left_semi")
        found.append(_pieces(texts, kind, pattern, group, least))
    found.append(_pieces(keyed, "hex", HEX, 0, HEX_LEAST))
    # Equal rows give equal matches; keep one of each.
    matches = found[0].unionByName(found[1]).unionByName(found[2]).distinct()
    running = Window.partitionBy("key", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("before") + F.col("width")).over(running)
    spans = matches.select("key", "kind", "kept", (end - F.col("width")).alias("start"), end.alias("end"))
    return saved(spans.where("kept").drop("kept"), "secrets-spans"), chosen, keyed


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of docs."""
    spans, chosen, keyed = base_spans(docs)
    order = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    listed = spans.groupBy("key").agg(
        *[F.sum((F.col("kind") == kind).cast("long")).alias(f"n_{kind}") for kind in KINDS],
        F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("o"), "kind", "end"))).alias("all"),
    )
    text = F.concat_ws(",", F.transform("all", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    listed = listed.select("key", *[f"n_{kind}" for kind in KINDS], text.alias("spans"))
    result = saved(
        keyed.select("doc_id", "key").join(listed, "key", "left").select(
            "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
            F.sha2(F.coalesce("spans", F.lit("")), 256).alias("base_sha256"),
            F.coalesce("spans", F.lit("")).alias("spans"),
        ),
        "secrets-result",
    )
    discard(spans)
    discard(chosen)
    return result
