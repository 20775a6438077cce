"""Personal data in texts, and the words that give it away, with DataFrame functions only.

Four kinds of values are found by their form.  Other words are found by what they tell:
over the distinct lines of all texts, a word that stands near a value carries
log2(p(word, value) / (p(word) p(value))) bits of it, out of log2(1 / p(value)).  A word
that discloses over three quarters of a value's information is generalised, one that
discloses over seven eighths is removed, wherever it stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import stored

# The forms of the four kinds.  Possessive repeats and looks behind only
# keep the time linear; each pattern finds what its plain form does.
PATTERNS = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTES = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
#: What every text with a value of the kind holds.
_NEEDS = {"email": "@", "phone": "+"}
TOKENS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

# What is cut from both ends of a token to get a term.
EDGES = "0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»‹›„¿¡…–—·•。、，！？（）"
TERM = r"^[\p{L}\p{M}'’-]{2,}$"
_SPACES, _TOKEN = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
#: Words on each side of a value that count as near it, and lines that must show a pair.
NEAR, SUPPORT = 8, 3
#: 1 / (1 - threshold) of the least threshold: 3/4 of a value's information.
GENERAL = 4
_BLOCK = 256
#: Common words are seen in one of so many lines.
_PARTS = 64


def _passes_luhn(digits: Column) -> Column:
    def weight(i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when((F.length(digits) - i) % 2 == 1, digit * 2).otherwise(digit)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + weight(i)) % 10 == 0


def _is_valid(kind: str, match: Column) -> Column:
    """Whether a match of the form is a value of the kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(_BYTES)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _passes_luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """All matches of the kind's form, valid or not."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    needed = _NEEDS.get(kind)
    none = F.array().cast("array<string>")
    return F.when(text.contains(needed), found).otherwise(none) if needed else found


def _running(lengths: str) -> Column:
    """Sums of the array column's elements up to each, block by block.

    The blocks keep a long array from costing the square of its length.
    """
    zero = F.array(F.lit(0).cast("bigint"))

    def within(block: Column) -> Column:
        return F.aggregate(
            block, zero, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
        )

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(_BLOCK))
    blocks = F.transform(starts, lambda at: within(F.slice(F.col(lengths), at, F.lit(_BLOCK))))
    sums = F.aggregate(
        blocks,
        zero,
        lambda sums, block: F.concat(
            sums,
            F.transform(
                F.slice(block, F.lit(2), F.lit(_BLOCK)), lambda x: x + F.element_at(sums, -1)
            ),
        ),
    )
    return F.slice(sums, F.lit(2), F.size(lengths))


def _with_spans(
    rows: DataFrame, cuts: dict[str, tuple[str, str, Callable[[Column], Column]]]
) -> DataFrame:
    """Adds, for each name, the array ``<name>_spans`` of (start, end, match).

    A cut is a text column, a pattern and which matches to keep; the matches are in the
    column ``<name>_found``.  Each step is a column of its own, so that no lambda
    function computes an array again for each element.
    """
    steps = {
        name: F.zip_with(
            F.slice(F.split(F.col(text), pattern), F.lit(1), F.size(f"{name}_found")),
            F.col(f"{name}_found"),
            lambda gap, match: (F.length(gap) + F.length(match)).cast("bigint"),
        )
        for name, (text, pattern, _) in cuts.items()
    }
    stepped = rows.select(
        "*",
        *[
            F.when(F.size(f"{name}_found") > 0, s).alias(f"{name}_steps")
            for name, s in steps.items()
        ],
    )

    def spans(name: str, keep: Callable[[Column], Column]) -> Column:
        ended = F.zip_with(
            _running(f"{name}_steps"),
            F.col(f"{name}_found"),
            lambda end, match: F.struct(
                (end - F.length(match)).alias("start"), end.alias("end"), match.alias("match")
            ),
        )
        none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
        some = F.size(f"{name}_found") > 0
        return F.when(some, F.filter(ended, lambda s: keep(s["match"]))).otherwise(none)

    return stepped.select(
        *rows.columns, *[spans(name, cut[2]).alias(f"{name}_spans") for name, cut in cuts.items()]
    )


def with_values(documents: DataFrame, text: str) -> DataFrame:
    """Adds, for each kind, the array ``<kind>_spans`` of (start, end, match) in the text."""
    found = documents.select("*", *[_matches(F.col(text), k).alias(f"{k}_found") for k in PATTERNS])
    cuts = {
        kind: (text, form, lambda match, kind=kind: _is_valid(kind, match))
        for kind, form in PATTERNS.items()
    }
    return _with_spans(found, cuts).drop(*[f"{kind}_found" for kind in PATTERNS])


def _terms(text: Column) -> Column:
    """The text's tokens without what is cut from their ends, in their order."""
    return F.transform(F.split(text, _SPACES), lambda token: F.btrim(token, F.lit(EDGES)))


def _contexts(line: Column, kind: str, near: int) -> Column:
    """(kind, value, terms near it) of each value of the kind in a line."""
    matches, gaps = F.col(f"{kind}_found"), F.split(line, PATTERNS[kind])

    def words(gap: Column) -> Column:
        return F.filter(_terms(gap), lambda term: term.rlike(TERM))

    def context(place: Column) -> Column:
        left = F.slice(F.reverse(words(place["left"])), F.lit(1), F.lit(near))
        right = F.slice(words(place["right"]), F.lit(1), F.lit(near))
        return F.struct(
            F.lit(kind).alias("kind"),
            place["match"].alias("value"),
            F.array_distinct(F.concat(left, right)).alias("terms"),
        )

    # Zipped outside the lambda function, so a line is cut once and not once per match.
    places = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(matches)).alias("left"),
        matches.alias("match"),
        F.slice(gaps, F.lit(2), F.size(matches)).alias("right"),
    )
    found = F.transform(places, context)
    kept = F.filter(found, lambda c: _is_valid(kind, c["value"]))
    none = F.array().cast("array<struct<kind:string,value:string,terms:array<string>>>")
    return F.when(F.size(matches) > 0, kept).otherwise(none)


def disclosing_terms(
    documents: DataFrame, text: str, near: int = NEAR, support: int = SUPPORT
) -> DataFrame:
    """Terms that tell too much of a value: term, removed (else generalised), disclosure.

    Counted are distinct lines of all texts, so copies and repeated lines tell nothing
    more.  ``disclosure`` is the greatest share of a value's information that the term
    tells.  A pair must be seen in ``support`` lines: a word of one line always tells all
    of a value that is nowhere else.
    """
    lines = (
        documents.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
        .where("line <> ''")
        .select("line", F.substring(F.unhex(F.sha2("line", 256)), 1, 16).alias("at"))
    )
    found = lines.select("*", *[_matches(F.col("line"), k).alias(f"{k}_found") for k in PATTERNS])
    some = [F.size(f"{k}_found") > 0 for k in PATTERNS]
    contexts = F.concat(*[_contexts(F.col("line"), k, near) for k in PATTERNS])
    seen = stored(
        found.where(some[0] | some[1] | some[2] | some[3])
        .select("at", F.explode(contexts).alias("c"))
        .select("at", "c.kind", "c.value", F.explode(F.concat(F.array(F.lit("")), "c.terms")).alias("term"))
        .distinct()
        .groupBy("kind", "value", "term")
        .agg(F.count("*").alias("n_pair"))
        .where(F.col("n_pair") >= support),
        "near-values",
    )
    values = seen.where("term = ''").select("kind", "value", F.col("n_pair").alias("n_value"))
    pairs = seen.where("term <> ''")
    n_lines = lines.select("at").distinct().count()
    joined = pairs.join(values, ["kind", "value"]).withColumn(
        "n_lines", F.lit(n_lines).cast("double")
    )
    # A term of more lines than this tells less than the least threshold of each value.
    most = F.max(F.col("n_pair") * F.pow(F.col("n_lines") / F.col("n_value"), 1 / GENERAL))
    limits = joined.groupBy("term").agg((most * 1.001 + 1).alias("most"))

    def counted(rows: DataFrame, terms: DataFrame) -> DataFrame:
        return (
            rows.select("at", F.explode(F.array_distinct(_terms(F.col("line")))).alias("term"))
            .join(terms.select("term"), "term")
            .distinct()
            .groupBy("term")
            .agg(F.count("*").alias("n_term"))
        )

    # Most terms near values are common words.  Those of too many lines in a part of the
    # lines have too many in all, and their lines need not be told apart.
    part = lines.where(F.pmod(F.xxhash64("at"), F.lit(_PARTS)) == 0)
    common = counted(part, limits).join(limits, "term").where("n_term > most").select("term")
    rare = stored(limits.join(common, "term", "left_anti").select("term"), "rare-terms")
    share = F.col("n_pair").cast("double") / F.col("n_term").cast("double")
    squared = F.col("share") * F.col("share")
    fourth = F.col("squared") * F.col("squared")
    joined = (
        joined.join(counted(lines, rare), "term")
        .withColumn("share", share)
        .withColumn("squared", squared)
        .withColumn("fourth", fourth)
    )
    informed = 1 + F.log("share") / F.log(F.col("n_lines") / F.col("n_value"))
    return (
        joined.where(F.col("fourth") * F.col("n_lines") >= F.col("n_value"))
        .select(
            "term",
            (F.col("fourth") * F.col("fourth") * F.col("n_lines") >= F.col("n_value")).alias("removed"),
            F.when(F.col("n_lines") > F.col("n_value"), informed).otherwise(1.0).alias("disclosure"),
        )
        .groupBy("term")
        .agg(F.max("removed").alias("removed"), F.max("disclosure").alias("disclosure"))
    )


def _replaced(text: Column, matches: Column, gaps: Column, new: Callable[[Column], Column]) -> Column:
    """The text with its matches replaced; the gaps are one more than the matches."""
    pieces = F.zip_with(gaps, matches, lambda gap, match: F.concat(gap, F.coalesce(new(match), F.lit(""))))
    return F.when(F.size(matches) > 0, F.array_join(pieces, "")).otherwise(text)


def _clean(rows: DataFrame) -> DataFrame:
    """Adds ``clean_text``: values by their kind's name, terms by their class or nothing."""
    rows = rows.withColumn("clean_text", F.col("body"))
    for kind, token in TOKENS.items():
        rows = rows.withColumn("clean_found", _matches(F.col("clean_text"), kind)).withColumn(
            "clean_text",
            _replaced(
                F.col("clean_text"),
                F.col("clean_found"),
                F.split(F.col("clean_text"), PATTERNS[kind]),
                lambda m, kind=kind, token=token: F.when(_is_valid(kind, m), token).otherwise(m),
            ),
        )

    def term(token: Column) -> Column:
        bare = F.btrim(token, F.lit(EDGES))
        name = F.when(bare.rlike(r"^\p{Lu}"), "<NAME>").otherwise("<WORD>")
        instead = F.when(F.array_contains("gone", bare), "").when(
            F.array_contains("general", bare), name
        )
        return F.when(instead.isNull(), token).otherwise(F.replace(token, bare, instead))

    tokens = F.regexp_extract_all(F.col("clean_text"), F.lit(_TOKEN), F.lit(0))
    worded = _replaced(F.col("clean_text"), tokens, F.split(F.col("clean_text"), _TOKEN), term)
    told = F.size(F.coalesce("general", F.array())) + F.size(F.coalesce("gone", F.array())) > 0
    return rows.withColumn(
        "clean_text", F.when(told, worded).otherwise(F.col("clean_text"))
    ).drop("clean_found")


def personal_data(
    documents: DataFrame,
    near: int = NEAR,
    support: int = SUPPORT,
    clean: bool = False,
) -> DataFrame:
    """Values and disclosing terms in each text, one row per row of documents.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (digest of
    ``kind:start:end`` of the four kinds), spans (the same of all kinds, then of the
    ``general`` and the ``removed`` terms, as text) and, if asked for, clean_text.
    Starts and ends are code points.  A null text is an empty one, ids may be null or
    repeated, equal rows give equal rows, and extra columns are not looked at.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    ).withColumn("digest", F.unhex(F.sha2("body", 256)))
    telling = stored(disclosing_terms(texts, "body", near, support), "telling-terms")
    # Which terms a text holds is found once for equal texts, and from terms alone.
    hits = (
        texts.select("digest", F.explode(F.array_distinct(_terms(F.col("body")))).alias("term"))
        .join(telling, "term")
        .groupBy("digest")
        .agg(
            F.collect_set(F.when(~F.col("removed"), F.col("term"))).alias("general"),
            F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("gone"),
        )
    )
    found = with_values(texts.join(hits, "digest", "left"), "body")
    told = F.size(F.coalesce("general", F.array())) + F.size(F.coalesce("gone", F.array())) > 0
    tokens = F.when(told, F.regexp_extract_all(F.col("body"), F.lit(_TOKEN), F.lit(0)))
    held = lambda t: F.array_contains(F.concat("general", "gone"), F.btrim(t, F.lit(EDGES)))
    marked = _with_spans(found.withColumn("term_found", tokens), {"term": ("body", _TOKEN, held)})

    def of_terms(kind: str, terms: str) -> Column:
        def trimmed(span: Column) -> Column:
            bare = F.btrim(span["match"], F.lit(EDGES))
            start = span["start"] + F.position(bare, span["match"]) - 1
            return F.concat_ws(":", F.lit(kind), start, start + F.length(bare))

        own = F.filter(
            "term_spans", lambda s: F.array_contains(terms, F.btrim(s["match"], F.lit(EDGES)))
        )
        return F.when(F.size("term_spans") > 0, F.transform(own, trimmed)).otherwise(
            F.array().cast("array<string>")
        )

    def of_values(kind: str) -> Column:
        return F.transform(
            f"{kind}_spans", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])
        )

    rows = marked.select(
        "doc_id", "body", "general", "gone",
        *[F.size(f"{kind}_spans").cast("long").alias(f"n_{kind}") for kind in PATTERNS],
        F.concat(*[of_values(kind) for kind in PATTERNS]).alias("base"),
        of_terms("general", "general").alias("general_spans"),
        of_terms("removed", "gone").alias("gone_spans"),
    )
    if clean:
        rows = _clean(rows)
    return rows.select(
        "doc_id",
        *[f"n_{kind}" for kind in PATTERNS],
        F.sha2(F.array_join("base", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat("base", "general_spans", "gone_spans"), ",").alias("spans"),
        *["clean_text"] * clean,
    )
