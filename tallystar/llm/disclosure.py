"""Information-theoretic sanitisation, in DataFrame functions only (operator 6).

Protected entities are the personal values in the corpus: e-mail and IP addresses, card and phone
numbers. A term in a text that holds an entity discloses it as far as both are found together: their
normalised pointwise mutual information,

    disclosure = log(co * N / (df_term * df_entity)) / log(N / co) * co / (co + 1) * m / (m + 1)

with counts of distinct texts over the whole corpus, so copies of a text count once; m is the smaller
of df_term and df_entity. The first part is 1 if both occur only together. The last two discount small
counts: a pair that was met in one text scores 0.25 at most, so a word is not taken out because it,
too, stands in that text alone; two texts give 0.44, four 0.64. Terms are removed at `remove_at`, and
replaced by their kind (a word or a number) at `generalise_at`, wherever they stand in a text that
holds the entity.

The base spans are the leftmost non-overlapping matches of each kind. Matches are set off by marks
in the text; the lengths between the marks, added up in a window per document, give the places, as
code points. Quantifiers are possessive and start where a run starts, so long runs cost one pass.

Null and empty texts have no spans. Repeated rows get the same spans; null ids are handled like
any other. Very long texts are searched whole. Ties in disclosure are treated alike. Extra columns
stay, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, text_digest, texts, unused

MARK = "\x01"
# The kinds in their order, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of 14 to 19 digits; shorter and longer ones fail anyway.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Every valid IP address or card number holds a match of this; one cheap pass over a text.
NUMBERS = r"[0-9](?:(?:[ -]?[0-9]){13}|[0-9]*\.[0-9]+\.[0-9]+\.[0-9])"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: Code points of a block of text to cut.
BLOCK = 1024
KEY = ["doc_id", "text_key"]
GROUP = ["df_entity", "a", "b"]
#: Digests up to this size, counted, are sent to every executor; what one takes in a hash table.
BROADCAST_BYTES, KEY_BYTES = 32 << 20, 96


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _may_have_spans(text: Column) -> Column:
    """False only for texts without any span; needs no other row."""
    return F.coalesce(
        text.rlike(NUMBERS)
        | (text.contains("@") & text.rlike(PATTERNS["email"]))
        | (text.contains("+") & text.rlike(PATTERNS["phone"])),
        F.lit(False),
    )


def _luhn(digits: Column) -> Column:
    """From the right, every second digit is doubled, nines cast out; the sum ends in 0."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.cast("int"), F.lit(0)))
    each = F.transform(
        figures,
        lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    # Without leading zeros, a part of more than three digits is too large, however long it is.
    small = F.forall(
        parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    )
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", _luhn(_digits(value)))
        .when(kind == "phone", F.length(_digits(value)).between(10, 15))
        .otherwise(True)
    )


def base_spans(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, kind, start, stop, value) of each valid match."""
    # A mark in the text itself becomes another sign of the same length, which no pattern has.
    clean = F.translate("text", MARK, "\x02")
    parts = [
        F.split(F.regexp_replace(clean, PATTERNS[k], f"{MARK}$0{MARK}"), MARK, -1).alias(k)
        for k in KINDS
    ]
    found = rows.select(*KEY, *parts).where(reduce(lambda a, b: a | b, [F.size(k) > 1 for k in KINDS]))

    def cut(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("i"),
                F.length(s).alias("length"),
                F.when(i % 2 == 1, s).alias("value"),
            ),
        )

    none = F.array().cast("array<struct<kind:string,i:int,length:int,value:string>>")
    cuts = [F.when(F.size(k) > 1, cut(k)).otherwise(none) for k in KINDS]
    found = scratch.saved(found.select(*KEY, F.concat(*cuts).alias("cuts")), "marked")
    before = Window.partitionBy(*KEY, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    spans = scratch.saved(
        found.dropDuplicates(KEY)
        .select(*KEY, F.explode("cuts").alias("c")).select(*KEY, "c.*")
        .withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .where("value is not null")
        .where(_valid(F.col("kind"), F.col("value")))
        .select(*KEY, "kind", "start", (F.col("start") + F.col("length")).alias("stop"), "value"),
        "spans",
    )
    scratch.drop("marked")
    return spans


def term_places(rows: DataFrame) -> DataFrame:
    """(text_key, term, start, stop): the words of each text, lower-case, at its code points."""
    marked = F.regexp_replace(F.translate("text", MARK, "\x02"), r"[\p{L}\p{N}]++", f"{MARK}$0{MARK}")
    before = Window.partitionBy("text_key").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.dropDuplicates(["text_key"])
        .select("text_key", F.posexplode(F.split(marked, MARK, -1)).alias("i", "piece"))
        .withColumn("length", F.length("piece").cast("long"))
        .withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
        .where("i % 2 = 1")
        .select(
            "text_key", F.lower("piece").alias("term"), "start",
            (F.col("start") + F.col("length")).alias("stop"),
        )
    )


def entity_groups(base: DataFrame) -> DataFrame:
    """(text_key, df_entity, a, b): the entities of each text; those of the same texts are one.

    Entities that stand in the same texts disclose alike. A text full of values that stand nowhere
    else has one group of them, so terms and groups of a text are few pairs.
    """
    entity = F.concat("kind", F.lit(":"), F.lower("value"))
    held = base.select("text_key", entity.alias("entity")).distinct()
    groups = held.groupBy("entity").agg(
        F.count("*").alias("df_entity"),
        F.bit_xor(F.xxhash64("text_key")).alias("a"),
        F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("b"),
    )
    return held.join(groups, "entity").select("text_key", *GROUP).distinct()


def _corpus_counts(rows: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """(term, df_term) of the wanted terms: in how many distinct texts of the corpus each stands.

    Texts without copies are counted where they lie. Only those with copies meet by their digests,
    unless their digests are too many to be sent to every executor; then all texts do.
    """
    parts = F.array_distinct(F.transform(F.split("text", r"[^\p{L}\p{N}]+"), F.lower))
    keys = rows.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select("text_key")
    copied = scratch.saved(keys, "copied")
    if copied.count() * KEY_BYTES <= BROADCAST_BYTES:
        copied = F.broadcast(copied)
        alone = rows.join(copied, "text_key", "left_anti").select(parts.alias("terms"))
        together = rows.join(copied, "text_key", "left_semi")
    else:
        alone, together = None, rows
    once = together.select("text_key", parts.alias("terms")).dropDuplicates(["text_key"])
    each = once.select("terms") if alone is None else alone.union(once.select("terms"))
    counted = (
        each.select(F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("df_term"))
        .join(wanted, "term", "left_semi")
    )
    return scratch.saved(counted, "terms")


def disclosing(
    rows: DataFrame, words: DataFrame, groups: DataFrame, scratch: Scratch, support: int, least: float
) -> DataFrame:
    """(text_key, term, disclosure) of the terms at or above `least` for an entity of their text."""
    total = float(max(rows.select("text_key").distinct().count(), 1))
    own = words.select("text_key", "term").distinct()
    counted = _corpus_counts(rows, own.select("term").distinct(), scratch)
    rarer, commoner = F.least("df_term", "df_entity"), F.greatest("df_term", "df_entity")
    most = F.log(total / F.col("co"))
    ratio = F.log(F.col("co") * total / (F.col("df_term") * F.col("df_entity"))) / most
    discount = F.col("co") / (F.col("co") + 1) * rarer / (rarer + 1)
    # A pair is found together as often as its rarer part at most: others cannot reach `least`.
    best = F.log(total / commoner) * F.pow(rarer / (rarer + 1), 2)
    possible = best >= F.log(total / rarer) * least - 1e-9
    found = scratch.saved(
        own.join(counted, "term").join(groups, "text_key").where(possible)
        .groupBy(*GROUP, "term", "df_term").agg(F.count("*").alias("co"))
        .where(F.col("co") >= support)
        .withColumn("disclosure", F.when(most > 0, F.least(ratio, F.lit(1.0)) * discount).otherwise(0.0))
        .where(F.col("disclosure") >= least)
        .select(*GROUP, "term", "disclosure"),
        "disclosing",
    )
    return (
        groups.join(found, GROUP)
        .groupBy("text_key", "term").agg(F.max("disclosure").alias("disclosure"))
    )


def _apart(found: DataFrame, base: DataFrame) -> DataFrame:
    """The terms that share no code point with personal data; the others go with it.

    Terms and values are passed in order, so a text full of values is not compared pair by pair.
    """
    values = base.select("text_key", "start", "stop").distinct().select(
        "*", F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("disclosure")
    )
    value = F.col("term").isNull()
    # Of those that begin at the same place, values come before terms.
    order = Window.partitionBy("text_key").orderBy("start", value.desc())
    before = order.rowsBetween(Window.unboundedPreceding, 0)
    after = (
        Window.partitionBy("text_key").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        found.unionByName(values)
        .withColumn("last", F.max(F.when(value, F.col("stop"))).over(before))
        .withColumn("next", F.min(F.when(value, F.col("start"))).over(after))
        .where("term is not null and coalesce(last <= start, true) and coalesce(next >= stop, true)")
        .drop("last", "next")
    )


class Sanitiser:
    """Spans of personal data and of terms that disclose it, and the texts without them."""

    def __init__(
        self,
        docs: DataFrame,
        support: int = 1,
        remove_at: float = 0.43,
        generalise_at: float = 0.4,
        id_col: str = "doc_id",
        text_col: str = "text",
    ) -> None:
        scratch = Scratch(docs.sparkSession)
        self.id_col, self.text_col = id_col, text_col
        self.rows = texts(docs, id_col, text_col).withColumn("text_key", text_digest(F.col("text")))
        self.base = base_spans(self.rows, scratch)
        groups = scratch.saved(entity_groups(self.base), "groups")
        holding = self.rows.where(_may_have_spans(F.col("text"))).join(
            groups.select("text_key").distinct(), "text_key", "left_semi"
        )
        words = scratch.saved(term_places(holding), "words")
        pairs = disclosing(self.rows, words, groups, scratch, support, generalise_at)
        kind = F.when(F.col("term").rlike(r"^\p{N}+$"), "[NUMBER]").otherwise("[WORD]")
        places = _apart(words.join(pairs, ["text_key", "term"]), self.base).select(
            "text_key", F.lit("term").alias("kind"), "start", "stop",
            F.when(F.col("disclosure") >= remove_at, "").otherwise(kind).alias("label"),
        )
        terms = self.base.select(*KEY).distinct().join(places, "text_key").select(
            *KEY, "kind", "start", "stop", "label"
        )
        label = F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("kind"))
        order = F.array_position(F.array(*[F.lit(k) for k in [*KINDS, "term"]]), F.col("kind"))
        # `far`: the furthest end of the spans before.
        earlier = (
            Window.partitionBy(*KEY).orderBy("start", "order", "stop", "kind", "label")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        self.spans = scratch.saved(
            self.base.select(*KEY, "kind", "start", "stop", label.alias("label")).union(terms)
            .withColumn("order", order)
            .withColumn("far", F.coalesce(F.max("stop").over(earlier), F.lit(0).cast("long")))
            .groupBy(*KEY)
            .agg(
                F.array_sort(
                    F.collect_list(F.struct("start", "order", "stop", "kind", "label", "far"))
                ).alias("spans")
            ),
            "all-spans",
        )
        scratch.keep("spans", "all-spans")

    def documents(self) -> DataFrame:
        """doc_id, n_email, n_ip, n_card, n_phone, base (array), spans (array)."""
        r, s = self.rows.alias("r"), self.spans.alias("s")
        empty = F.array().cast(self.spans.schema["spans"].dataType)
        joined = r.join(
            s,
            (F.col("r.text_key") == F.col("s.text_key"))
            & F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")),
            "left",
        ).select("r.doc_id", F.coalesce("s.spans", empty).alias("spans"))
        counts = {f"n_{k}": F.size(_of_kind("spans", k)).cast("long") for k in KINDS}
        return joined.withColumns(
            counts | {"base": F.filter("spans", lambda x: x.kind != "term")}
        )

    def sanitised(self, docs: DataFrame) -> DataFrame:
        """The rows of the searched table, their texts without what the spans cover.

        Texts that can't have spans stay as they are and out of the join, so that most texts are
        not shuffled. Texts with spans are cut into blocks first, so that a text of many spans is
        not read from its beginning for each of them.
        """
        text = F.col(f"`{self.text_col}`").cast("string")
        digest, i, key, found_, cut_ = unused(docs.columns, "digest", "id", "key", "found", "cut")
        spans = self.spans.select(
            F.col("doc_id").alias(i), F.col("text_key").alias(key), F.col("spans").alias(found_)
        )
        blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
        kept = F.transform(
            found_,
            lambda x: F.when(
                x.start >= x.far, F.concat(_between(cut_, x.far, x.start), x.label)
            ).otherwise(""),
        )
        last = F.array_max(F.transform(found_, lambda x: x.stop))
        cut = F.concat(F.array_join(kept, ""), _between(cut_, last, F.length(text)))
        own = [F.col(f"`{c}`") for c in docs.columns]
        plain = docs.where(~_may_have_spans(text)).withColumn(self.text_col, text).select(*own)
        found = (
            docs.where(_may_have_spans(text))
            .withColumn(digest, text_digest(text))
            .join(
                spans,
                (F.col(digest) == F.col(key)) & F.col(f"`{self.id_col}`").eqNullSafe(F.col(i)),
                "left",
            )
            .withColumn(cut_, F.when(F.col(found_).isNotNull(), blocks))
            .withColumn(self.text_col, F.when(F.col(found_).isNotNull(), cut).otherwise(text))
            .select(*own)
        )
        return plain.union(found)


def _between(blocks: str, start: Column, stop: Column) -> Column:
    """Code points from start to stop of a text in blocks; reads the blocks between alone."""
    first, last = F.floor(start / BLOCK), F.floor((stop - 1) / BLOCK)
    joined = F.array_join(F.slice(blocks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    return F.substring(joined, (start - first * BLOCK + 1).cast("int"), (stop - start).cast("int"))


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: x.kind == kind)


def joined_spans(spans: str) -> Column:
    """kind:start:stop of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat(x.kind, F.lit(":"), x.start.cast("string"), F.lit(":"), x.stop.cast("string")),
        ),
        ",",
    )
