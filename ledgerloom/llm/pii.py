"""Personal data: base patterns, and terms that disclose what the patterns protect.

Protected entities are the values that the base patterns find (e-mail, IP, card and phone numbers).
A term of the same document may reveal an entity to who knows the corpus, even after the value itself is masked. How
strongly is estimated from the corpus, for every entity and every term of its documents: with document counts ``n``, ``n(e)``,
``n(t)`` and ``n(e, t)`` the pointwise mutual information ``ln(p n / n(e))`` is set against the entity's own information
``ln(n / n(e))``. ``p`` is the share of the term's documents that hold the entity, not as counted (``n(e, t) / n(t)``) but the lower end
of its Wilson interval at ``Z``, so a term and an entity that met once are evidence, but less than those that met often. A
term that discloses at least ``GENERALISE`` of the information is replaced by a general label, from ``REMOVE`` on it is taken
out - wherever it stands in the documents that hold the entity. Terms are runs of letters of any length; words that touch an
entity's letters are part of it.

Work is linear in texts and matches. Entities that stand in the same documents are one *carrier*, as all counts agree, so a log with
thousands of addresses pairs its words once. A pair can only reach the threshold where ``n(t) <= n(e)**GENERALISE *
n**(1 - GENERALISE)``; other pairs are left out before they are formed. Places come from running sums in
stretches, and texts are cut in pieces of ``PIECE`` characters, so no step copies what lies before it.

Only DataFrame functions are used. Counts cover all documents and are combined before the shuffle;
no entity, term or document is gathered in one task.

NULL and empty texts have no spans (a NULL text stays NULL). Rows that agree in id and text get
the same spans. An entity that stands in every document has no information to disclose. An empty table gives
an empty result. Working columns take free names; ``spans`` and the text are the only columns replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, free_name, let, read

# Kinds in the order of the digest, and their patterns. The guards in front keep the
# search linear on long runs: a match starts at a run's first character or where the last match ended.
KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
# A whole run of 16 to 19 digits; shorter and longer runs fail as a whole.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LABELS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", "")

_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_TERM = r"\p{L}++"
_FILLER = "\ua7f7"  # a letter of medieval epigraphy; a text's own words with it are no terms
_TERM_KIND = KINDS.index("term")
_REMOVED = _TERM_KIND + 1

#: Normal quantile of the interval's confidence.
Z = 1.96
GENERALISE = 0.8
REMOVE = 0.95
#: Numbers that a running calculation goes through in one go, and characters in a piece of a text.
STRETCH = 64
PIECE = 1024


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    match kind:
        case "ip":
            return value.rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z")
        case "card":
            return F.call_function("luhn_check", digits)
        case "phone":
            return F.length(digits).between(8, 15)
    return F.lit(True)


def _before(numbers: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array what ``merge`` makes of 0 and the numbers before it.

    Growing an array by one copies it, so stretches are worked on alone, after what lies before each is known.
    """

    def scanned(part: Column, first: Column) -> Column:
        begin = F.struct(first.alias("now"), F.array().cast("array<int>").alias("out"))
        step = lambda done, v: F.struct(merge(done["now"], v).alias("now"), F.concat(done["out"], F.array(done["now"])).alias("out"))
        return F.aggregate(part, begin, step, lambda done: done["out"])

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, b: merge(a, b)))
        return F.flatten(F.zip_with(parts, scanned(totals, F.lit(0)), scanned))

    def cut(all_: Column) -> Column:
        begins = F.sequence(F.lit(1), F.size(all_), F.lit(STRETCH))
        return F.when(F.size(all_) > 0, let(F.transform(begins, lambda at: F.slice(all_, at, STRETCH)), joined)).otherwise(F.array().cast("array<int>"))

    return let(numbers, cut)


def _starts(lengths: Column, gaps: Column) -> Column:
    """Where each match starts, from the lengths of the matches and of the parts before them."""

    def placed(front: Column) -> Column:
        return F.zip_with(_before(F.zip_with(front, lengths, lambda g, n: g + n), lambda a, b: a + b), front, lambda before, g: before + g)

    return let(F.slice(gaps, F.lit(1), F.size(lengths)), placed)


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text in pieces; no more pieces than these are read."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(end > start, F.substr(near, start - first * PIECE + 1, end - start)).otherwise(F.lit(""))


def _rewritten(text: Column, spans: Column, part: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with ``part`` (of pieces, span, and where the spans before it end) for each span by start; what follows the last stays."""

    def parts(pieces: Column, by_start: Column, upto: Column) -> Column:
        changed = F.zip_with(by_start, upto, lambda s, u: part(pieces, s, u))
        end = F.greatest(F.array_max(F.transform(by_start, lambda s: s["end"])), F.lit(0))
        return F.array_join(F.concat(changed, F.array(_cut(pieces, end, F.length(text)))), "")

    def placed(by_start: Column) -> Column:
        upto = _before(F.transform(by_start, lambda s: s["end"]), F.greatest)
        return let(F.struct(_pieces(text).alias("p"), upto.alias("u")), lambda both: parts(both["p"], by_start, both["u"]))

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.when(F.size(spans) > 0, let(by_start, placed)).otherwise(text)


def _located(df: DataFrame, text: Column, pattern: str, name: str, possible: Column) -> DataFrame:
    """Add ``name``: the matches of a pattern as structs (start, value), in code points."""
    found, starts = free_name(df, "_found"), free_name(df, "_starts")
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    parts = F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(none)
    df = df.withColumn(starts, _starts(F.transform(found, F.length), F.transform(parts, F.length)))
    places = F.zip_with(starts, found, lambda start, value: F.struct(start.alias("start"), value.alias("value")))
    return df.withColumn(name, places).drop(found, starts)


def with_base_spans(df: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Add ``name``: an array of (kind, start, end, value) by kind and start; ``kind`` is an index of ``KINDS``."""
    value = F.coalesce(F.col(text), F.lit(""))
    possible = {
        "email": (EMAIL, F.contains(value, F.lit("@"))),
        "ip": (IP, value.rlike(r"[0-9]\.[0-9]")),
        "card": (CARD, value.rlike(r"[0-9][\x20-]?[0-9]")),
        "phone": (PHONE, value.rlike(r"\+[0-9]")),
    }
    named = {kind: free_name(df, f"_{kind}") for kind in possible}
    for kind, (pattern, hint) in possible.items():
        df = _located(df, value, pattern, named[kind], hint)

    def spans(kind: str) -> Column:
        valid = F.filter(F.col(named[kind]), lambda s: _valid(kind, s["value"]))
        return F.transform(
            valid,
            lambda s: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                s["start"].alias("start"),
                (s["start"] + F.length(s["value"])).alias("end"),
                s["value"].alias("value"),
            ),
        )

    return df.withColumn(name, F.concat(*[spans(kind) for kind in possible])).drop(*named.values())


def _row_key(row_id: str, text: str) -> Column:
    """Rows that agree in id and text share a key, as they share their spans."""
    value = F.coalesce(F.col(text), F.lit(""))
    return F.md5(F.concat(F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.lit("\x00"), value).cast("binary"))


def _hidden(text: Column, spans: Column) -> Column:
    """The text with the letters inside spans replaced by ``_FILLER``; every other character stays in its place."""

    def part(pieces: Column, s: Column, upto: Column) -> Column:
        start = F.greatest(upto, s["start"])
        return F.concat(_cut(pieces, upto, start), F.regexp_replace(_cut(pieces, start, s["end"]), r"\p{L}", _FILLER))

    return _rewritten(text, spans, part)


def _entity(span: Column) -> Column:
    """The digest of a base span's kind and value."""
    return F.md5(F.concat_ws(":", span["kind"], span["value"]).cast("binary")).alias("entity")


def hidden_texts(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """The rows with entities: ``row_key``, ``_spans`` and ``_text``, the text without the letters of entities."""
    marked = with_base_spans(df.select(row_id, text), text, "_spans").where(F.size("_spans") > 0)
    return marked.select(_row_key(row_id, text).alias("row_key"), "_spans", _hidden(F.col(text), F.col("_spans")).alias("_text"))


def term_documents(df: DataFrame, text: str) -> DataFrame:
    """Each term of the corpus and the number of rows that hold it."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+"))
    terms = df.select(F.explode(F.filter(words, lambda w: w != "")).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("n_t"))


def carriers(hidden: DataFrame) -> DataFrame:
    """Per ``row_key`` the sets of documents that its entities stand in: ``carrier`` (the set's size and two sums of its keys)."""
    entities = hidden.select("row_key", F.explode(F.array_distinct(F.transform("_spans", _entity))).alias("entity"))
    sums = [F.bit_xor(F.xxhash64("row_key", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    sets = entities.groupBy("entity").agg(F.count("*").alias("n_e"), *sums)
    return entities.join(sets, "entity").select("row_key", F.struct("n_e", "x1", "x2").alias("carrier")).distinct()


def lower_share(part: Column, whole: Column, z: float = Z) -> Column:
    """The lower end of the Wilson interval of ``part / whole``."""
    p, z2 = part / whole, z * z
    spread = z * F.sqrt(p * (1 - p) / whole + z2 / (4 * whole * whole))
    return (p + z2 / (2 * whole) - spread) / (1 + z2 / whole)


def disclosing_terms(df: DataFrame, hidden: DataFrame, text: str) -> DataFrame:
    """``row_key``, ``term``, ``kind``: words anywhere in a text of ``hidden_texts`` that disclose an entity of it."""
    carried = stage_table(carriers(hidden), "entity-carriers")
    n = df.agg(F.count("*").cast("double").alias("n")).scalar()
    most = carried.agg(F.max("carrier.n_e").cast("double").alias("most")).scalar()

    def highest(n_e: Column) -> Column:
        """The documents of a term that may disclose an entity of ``n_e`` documents; rounding up loses none."""
        return F.ceil(F.pow(n_e.cast("double"), F.lit(GENERALISE)) * F.pow(n, F.lit(1 - GENERALISE)) * (1 + 1e-9))

    rare = term_documents(df, text).where(F.col("n_t") <= highest(most))
    words = F.filter(F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}]+")), lambda w: (w != "") & ~F.contains(w, F.lit(_FILLER)))
    held = hidden.select("row_key", F.explode(words).alias("term")).join(rare, "term")
    met = held.join(carried, "row_key").where(F.col("n_t") <= highest(F.col("carrier.n_e")))
    met = stage_table(met.select("row_key", "carrier", "term", "n_t"), "terms-with-entities")

    own = F.log(n / F.col("carrier.n_e"))
    mutual = F.log(lower_share(F.col("n_et"), F.col("n_t")) * n / F.col("carrier.n_e"))
    together = met.groupBy("carrier", "term").agg(F.count("*").alias("n_et"), F.first("n_t").alias("n_t"))
    shares = together.select("carrier", "term", F.when(own > 0, mutual / own).alias("share")).where(F.col("share") >= GENERALISE)
    kind = F.when(F.col("share") >= REMOVE, F.lit(_REMOVED)).otherwise(F.lit(_TERM_KIND)).alias("kind")
    found = met.join(shares.select("carrier", "term", kind), ["carrier", "term"])
    return found.groupBy("row_key", "term").agg(F.max("kind").cast("int").alias("kind"))


def term_spans(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Per ``row_key`` the places of its disclosing terms: ``terms``, an array of (kind, start, end, value)."""
    hidden = stage_table(hidden_texts(df, row_id, text).dropDuplicates(["row_key"]), "entity-texts")
    terms = stage_table(disclosing_terms(df, hidden, text), "disclosing-terms")
    told = hidden.join(terms.select("row_key").distinct(), "row_key", "left_semi").select("row_key", "_text")
    placed = _located(told, F.col("_text"), _TERM, "_words", F.lit(True)).select("row_key", F.explode("_words").alias("w"))
    placed = placed.select("row_key", F.lower("w.value").alias("term"), "w.start", (F.col("w.start") + F.length("w.value")).alias("end"))
    spans = F.struct("kind", "start", "end", F.col("term").alias("value"))
    return placed.join(terms, ["row_key", "term"]).groupBy("row_key").agg(F.collect_list(spans).alias("terms"))


def with_spans(df: DataFrame, row_id: str, text: str = "text", name: str = "spans") -> DataFrame:
    """Add ``name``: base spans and disclosing terms as (kind, start, end, value), by kind and start.

    Kinds are indices of ``KINDS``; the one after the last marks terms to be removed. ``df`` is
    read several times: hand in a table, not a costly plan.
    """
    key = free_name(bounded(df), "_row_key")
    right = free_name(df, "_right_terms")
    terms = term_spans(df, row_id, text).withColumnsRenamed({"row_key": key, "terms": right})
    marked = with_base_spans(df, text, name).withColumn(key, _row_key(row_id, text))
    joined = marked.join(terms, key, "left")
    both = F.when(F.col(right).isNull(), F.col(name)).otherwise(F.concat(F.col(name), F.col(right)))
    return joined.withColumn(name, F.array_sort(both)).drop(key, right)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its label; what overlapping spans cover is replaced as a whole."""
    labels = F.array(*map(F.lit, LABELS))

    def part(pieces: Column, s: Column, upto: Column) -> Column:
        return F.when(s["start"] >= upto, F.concat(_cut(pieces, upto, s["start"]), F.element_at(labels, s["kind"] + 1))).otherwise(F.lit(""))

    return _rewritten(text, spans, part)


def sanitised(df: DataFrame, row_id: str, text: str = "text") -> DataFrame:
    """The rows of ``df`` with personal data masked, disclosing terms generalised or removed."""
    spans = free_name(df, "_spans")
    marked = with_spans(df, row_id, text, spans)
    return marked.withColumn(text, masked(F.col(text), F.col(spans))).select(*df.columns)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined by kind as listed, then start."""
    kinds = F.array(*map(F.lit, KINDS))
    known = F.lit(_TERM_KIND)  # terms to be removed are terms
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(F.least(s["kind"], known).alias("kind"), s["start"], s["end"])))
    return F.concat_ws(",", F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])))


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", "spans")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < _TERM_KIND)
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:_TERM_KIND]],
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] >= _TERM_KIND)).cast("long").alias("n_term"),
    )
