"""N-gram Jaccard join by grouped prefixes (operator 10).

Documents are compared by their sets of word shingles. Two sets link if the shared part is at
least `percent` hundredths of the union; documents that links connect form a component.

1. All sets are ordered alike: shingles of rare hash slots first (a table of SLOTS counts over
   all documents), then by hash. Any order gives right results; this one keeps frequent lines
   and passages out of the prefixes.
2. Equal sets are collapsed into one; sets with the same size and prefix into one group.
3. Groups that share a prefix shingle are pairs if sizes and positions allow enough overlap.
4. Stars first: each shingle's groups are compared with the group that has it earliest, as an
   original among its edited copies does. What is linked then is one component, and pairs inside
   a component need no comparison. Then every remaining pair between components is compared:
   per shingle, members of the largest component are met only by the others.
5. A pair of groups goes on if the prefix shingles they share leave room for enough overlap: what
   one prefix does not share, up to the earlier of the two prefixes' ends, the other set lacks.
6. Such pairs are expanded to their members, and these are verified on whole sets.

No pair that could link different components is left out, whatever the sizes of groups. With
`whole`, every pair that could link is compared instead of step 4, so that all links between
different sets are known, not only enough to connect them. Groups of one shingle then meet in
blocks of BLOCK, so a shingle that many groups share is spread over many tasks.

Null, empty or blank texts have no shingles and are linked with nothing. Fewer words than a
shingle form one shingle of all words. Repeated rows are copies of each other; null ids are kept,
and a component's id is its smallest id that is not null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.components import connected
from tallystar.llm.tables import Scratch, bit_table, id_type, passes, ship, texts, unused
from tallystar.llm.text import (
    NOT_SPACE,
    Texts,
    U,
    chunks,
    distinct,
    lists,
    mix,
    shingles,
    span_hashes,
    words,
)

#: Slots of the table that orders shingles by frequency; 8 MB on the driver and in each worker.
SLOTS = 1 << 21
#: Slots that are added up together, and first sums of each such range.
RANGE, FAN = 1 << 14, 256
#: Groups of one shingle that meet those of another block in one place, where all links are wanted.
BLOCK = 256


def _grams(texts_: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    found = words(texts_, NOT_SPACE)
    return shingles(found, span_hashes(texts_, found.start, found.end, lower=True), k)


def _squeezed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").view(np.uint8)
                                                      .reshape(-1, 8).T.tobytes())


def _opened(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _count_slots(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(SLOTS, np.int64)
        for _, texts_ in chunks(batches):
            total += np.bincount(_grams(texts_, k)[1] & U(SLOTS - 1), minlength=SLOTS)
        parts = total.reshape(-1, RANGE)
        yield pa.record_batch(
            {
                "part": pa.array(np.arange(len(parts)), pa.int32()),
                "fan": pa.array(np.full(len(parts), TaskContext.get().partitionId() % FAN), pa.int32()),
                "counts": pa.array([_squeezed(p) for p in parts], pa.binary()),
            }
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(RANGE, np.int64)
    for counts in table["counts"]:
        total += _opened(counts.as_py())
    return pa.table(
        {
            "part": table["part"][:1],
            "fan": table["fan"][:1],
            "counts": pa.array([_squeezed(total)], pa.binary()),
        }
    )


def slot_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles of all documents by hash slot; the result has the same size for any input.

    Each task sends its counts packed; they are added up in two steps, so that no task gets
    those of all others.
    """
    schema = "part int, fan int, counts binary"
    counted = (
        docs.select("text").mapInArrow(_count_slots(k), schema)
        .groupBy("part", "fan").applyInArrow(_added, schema)
        .groupBy("part").applyInArrow(_added, schema)
        .select("part", "counts").toArrow()
    )
    counts = np.zeros((SLOTS // RANGE, RANGE), np.int64)
    for part, data in zip(counted["part"].to_pylist(), counted["counts"].to_pylist(), strict=True):
        counts[part] = _opened(data)
    return np.minimum(counts.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def _signatures(k: int, percent: int, ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_ in chunks(batches):
            text, gram = distinct(*_grams(texts_, k))
            n = np.bincount(text, minlength=len(texts_))
            ends = np.cumsum(n)
            keys = []
            for salt in (U(1), U(2)):  # a set's key: sums of two scramblings of its members
                sums = np.zeros(len(gram) + 1, np.uint64)
                np.cumsum(mix(gram ^ mix(np.full(1, salt))), out=sums[1:])
                keys.append(mix(sums[ends] - sums[ends - n] + n.astype(np.uint64)))
            rank = ranks.value[gram & U(SLOTS - 1)]
            order = np.lexsort((gram, rank, text))
            length = np.where(n > 0, n + (-percent * n) // 100 + 1, 0)
            place = np.arange(len(gram)) - np.repeat(ends - n, n)
            prefix = gram[order][place < np.repeat(length, n)].view(np.int64)
            bounds = np.concatenate([[0], np.cumsum(length)])
            last = np.concatenate([np.zeros(1, np.uint64), gram[order]])[np.where(n > 0, ends - n + length, 0)]
            last_rank = ranks.value[last & U(SLOTS - 1)]
            group = []
            for salt in (U(3), U(4)):
                sums = np.zeros(len(prefix) + 1, np.uint64)
                np.cumsum(mix(prefix.view(np.uint64) ^ mix(np.full(1, salt))), out=sums[1:])
                group.append(mix(sums[bounds[1:]] - sums[bounds[:-1]]))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "n": pa.array(n, pa.int64()),
                    "s1": keys[0].view(np.int64),
                    "s2": keys[1].view(np.int64),
                    "p1": group[0].view(np.int64),
                    "p2": group[1].view(np.int64),
                    "last_rank": pa.array(last_rank, pa.int64()),
                    "last_gram": (last ^ U(1 << 63)).view(np.int64),  # in the same order
                    "prefix": lists(prefix, bounds, pa.int64()),
                }
            )

    return run


def _sets(k: int, kind: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("row_key").to_numpy()
                yield batch.filter(pa.array(passes(table.value, keys)))

        for batch, texts_ in chunks(wanted()):
            text, gram = distinct(*_grams(texts_, k))
            bounds = np.searchsorted(text, np.arange(len(texts_) + 1))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "grams": lists(gram.view(np.int64), bounds, pa.int64()),
                }
            )

    return run


class GroupedPrefixJoin:
    """The join over one table; `components()` and, with `whole`, `links()` are its results."""

    def __init__(
        self,
        docs: DataFrame,
        k: int = 4,
        percent: int = 85,
        id_col: str = "doc_id",
        text_col: str = "text",
        whole: bool = False,
    ) -> None:
        if not 0 < percent <= 100 or k < 1:
            raise ValueError("percent must be from 1 to 100, k at least 1")
        spark = docs.sparkSession
        ship(spark)
        self.percent, self.whole, self.scratch = percent, whole, Scratch(spark)
        self.id_col, self.text_col = id_col, text_col
        self.k, self.kind = k, id_type(docs, id_col).simpleString()
        self.texts = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
        ranks = spark.sparkContext.broadcast(slot_counts(self.texts, k))
        self.signed = self.scratch.saved(
            self.texts.mapInArrow(
                _signatures(k, percent, ranks),
                f"doc_id {self.kind}, text_key long, n long, s1 long, s2 long, p1 long, p2 long, "
                "last_rank long, last_gram long, prefix array<long>",
            ),
            "signed",
        )
        # One row per distinct set, numbered; the number is fixed by writing it.
        self.sets = self.scratch.saved(
            self.signed.where("n > 0")
            .groupBy("n", "s1", "s2", "p1", "p2", "last_rank", "last_gram")
            .agg(
                F.min("doc_id").alias("least_id"),
                F.min(
                    F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
                ).alias("one"),
            )
            .withColumn("sid", F.monotonically_increasing_id()),
            "sets",
        )
        # Sets of one size and prefix form a group; its number is that of its first member.
        groups = self.sets.groupBy("n", "p1", "p2", "last_rank", "last_gram").agg(
            F.min("sid").alias("gid"), F.count("*").alias("members")
        )
        self.groups = self.scratch.saved(groups, "groups")
        self.members = self.scratch.saved(
            self.sets.select("n", "p1", "p2", "sid")
            .join(self.groups.select("n", "p1", "p2", "gid"), ["n", "p1", "p2"])
            .select("gid", "sid"),
            "members",
        )
        postings = self._postings()
        # The prefixes are in the postings now; the rest of the signatures stays.
        self.signed = self.scratch.saved(self.signed.drop("prefix", "last_rank", "last_gram"), "keys")
        self.scratch.drop("signed", "prefixes")
        if whole:
            self._links = self._verified(self._all_pairs(postings), "every")
            self.scratch.drop("blocks", "postings", "groups", "members")
            self.labels = connected(self._links.select("a", "b"), self.scratch, "all")
            return
        stars = self._verified(self._star_pairs(postings), "stars")
        self.scratch.drop("centres")
        first = connected(stars, self.scratch, "first")
        rest = self._verified(self._cross_pairs(postings, first), "rest")
        self.scratch.drop("parts", "posted-parts", "mixed", "mixed-rows", "postings", "groups", "members")
        self._links = stars.union(rest)
        # The stars of the first labels stand for the links they came from.
        joined = first.where("v <> c").select(F.col("v").alias("a"), F.col("c").alias("b"))
        self.labels = (
            connected(joined.union(rest.select("a", "b")), self.scratch, "all")
            if not rest.isEmpty()
            else first
        )

    def _reach(self, n, pos):
        """Largest size of a set that may link if the first shared shingle is at `pos`."""
        return F.floor((n - pos) * F.lit(100 + self.percent) / F.lit(self.percent)) - n

    def _postings(self) -> DataFrame:
        """(token, gid, n, pos, reach) of tokens in prefixes of two sets or more."""
        first = self.groups.select("gid", "n", "members").join(
            self.sets.select(F.col("sid").alias("gid"), "one"), "gid"
        ).select("gid", "n", "members", F.col("one.doc_id").alias("__id"), F.col("one.text_key"))
        owners = self.scratch.saved(
            self.signed.where("n > 0").select("doc_id", "text_key", "prefix")
            .join(self.scratch.saved(first, "first"), "text_key")
            .where(F.col("doc_id").eqNullSafe(F.col("__id")))
            .select("gid", "n", "members", "prefix"),
            "prefixes",
        )
        self.scratch.drop("first")
        rows = owners.select("gid", "n", "members", F.posexplode("prefix").alias("pos", "token"))
        shared = rows.groupBy("token").agg(F.sum("members").alias("of")).where("of > 1")
        postings = self.scratch.saved(
            rows.join(self.scratch.saved(shared.select("token"), "shared"), "token")
            .select(
                "token", "gid", "n", "pos", self._reach(F.col("n"), F.col("pos")).alias("reach")
            )
            .distinct(),
            "postings",
        )
        self.scratch.drop("shared")
        return postings

    def _grams_of(self, sids: DataFrame, name: str) -> DataFrame:
        """Whole sets of the given numbers, from one document of each."""
        wanted = self.scratch.saved(
            sids.join(self.sets.select("sid", "one"), "sid").select(
                "sid", F.col("one.doc_id").alias("__id"), F.col("one.text_key").alias("text_key"),
                F.xxhash64("one.doc_id", "one.text_key").alias("row_key"),
            ),
            f"{name}-wanted",
        )
        table = self.texts.sparkSession.sparkContext.broadcast(bit_table(wanted, "row_key"))
        found = self.texts.withColumn("row_key", F.xxhash64("doc_id", "text_key")).mapInArrow(
            _sets(self.k, self.kind, table),
            f"doc_id {self.kind}, text_key long, grams array<long>",
        )
        grams = self.scratch.saved(
            found.join(wanted, "text_key").where(F.col("doc_id").eqNullSafe(F.col("__id")))
            .dropDuplicates(["sid"]).select("sid", "grams"),
            f"{name}-grams",
        )
        self.scratch.drop(f"{name}-wanted")
        return grams

    def _may_link(self, a: str, b: str):
        """Sizes and positions of the shared shingle leave room for enough overlap."""
        return (
            (F.col(f"{a}.n") <= F.col(f"{b}.reach"))
            & (F.col(f"{b}.n") <= F.col(f"{a}.reach"))
            & (F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * self.percent)
        )

    def _star_pairs(self, postings: DataFrame) -> DataFrame:
        """(a, b): the first member of a shingle's earliest group, and the others' members."""
        centre = self.scratch.saved(
            postings.groupBy("token").agg(F.min(F.struct("pos", "n", "gid", "reach")).alias("c"))
            .select("token", "c.gid", "c.n", "c.reach"),
            "centres",
        )
        pairs = (
            postings.alias("x").join(centre.alias("y"), "token")
            .where((F.col("x.gid") != F.col("y.gid")) & self._may_link("x", "y"))
            .select(F.col("y.gid").alias("ga"), F.col("x.gid").alias("gb"))
            .distinct()
        )
        pairs = self._roomy(pairs, postings, "stars")
        return pairs.join(self.members.withColumnRenamed("gid", "gb"), "gb").select(
            F.col("ga").alias("a"), F.col("sid").alias("b")
        ).union(
            self.members.where("sid <> gid").select(F.col("gid").alias("a"), F.col("sid").alias("b"))
        )

    def _all_pairs(self, postings: DataFrame) -> DataFrame:
        """(a, b), a < b: all members whose groups share a prefix shingle and may link, or are one."""
        sizes = postings.groupBy("token").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
        rows = self.scratch.saved(
            postings.join(sizes.where("blocks > 1"), "token", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks"))),
            "blocks",
        )
        # A block meets itself and each later one once.
        first = rows.withColumn("other", F.explode(F.expr("sequence(block, blocks - 1)")))
        second = rows.withColumn("one", F.explode(F.expr("sequence(0L, block)")))
        met = (
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.block") == F.col("y.one")) & (F.col("x.other") == F.col("y.block"))
        )
        pairs = (
            first.alias("x").join(second.alias("y"), met)
            .where((F.col("x.block") < F.col("y.block")) | (F.col("x.gid") < F.col("y.gid")))
            .where(self._may_link("x", "y"))
            .select(F.least("x.gid", "y.gid").alias("ga"), F.greatest("x.gid", "y.gid").alias("gb"))
            .distinct()
        )
        pairs = self._roomy(pairs, postings, "every")
        one, two = self.members.toDF("ga", "a"), self.members.toDF("gb", "b")
        within = one.join(two, F.col("ga") == F.col("gb")).where("a < b").select("a", "b")
        between = pairs.join(one, "ga").join(two, "gb")
        return between.select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).union(within)

    def _roomy(self, pairs: DataFrame, postings: DataFrame, name: str) -> DataFrame:
        """Pairs of groups (ga, gb, ...) whose shared prefix shingles leave room for a link."""
        pairs = self.scratch.saved(pairs, f"{name}-pairs")
        own = postings.select("gid", "token")
        two = pairs.select("ga", "gb").where("ga <> gb").distinct()
        shared = (
            two.join(own.withColumnRenamed("gid", "ga"), "ga")
            .join(own.withColumnRenamed("gid", "gb"), ["gb", "token"])
            .groupBy("ga", "gb").agg(F.count("*").alias("shared"))
        )
        n = F.col("n")
        short = n + F.floor(n * -self.percent / F.lit(100.0)) + 1  # length of the prefix
        shape = self.groups.select(
            "gid", "n", (n - short).alias("rest"), F.struct("last_rank", "last_gram").alias("last")
        )
        a, b = (shape.select(*[F.col(c).alias(f"{x}_{c}") for c in shape.columns]) for x in "ab")
        most = F.col("shared") + F.when(
            F.col("a_last") <= F.col("b_last"), F.col("a_rest")
        ).otherwise(F.col("b_rest"))
        roomy = (
            shared.join(a, F.col("ga") == F.col("a_gid")).join(b, F.col("gb") == F.col("b_gid"))
            .where(most * (100 + self.percent) >= (F.col("a_n") + F.col("b_n")) * self.percent)
            .select("ga", "gb")
        )
        rest = pairs.where("ga = gb")
        return pairs.join(roomy, ["ga", "gb"]).unionByName(rest)

    def _cross_pairs(self, postings: DataFrame, labels: DataFrame) -> DataFrame:
        """(a, b): members of different components whose groups share a shingle and may link."""
        parts = self.scratch.saved(
            self.members.join(labels.withColumnRenamed("v", "sid"), "sid", "left")
            .select("gid", "sid", F.coalesce("c", "sid").alias("part")),
            "parts",
        )
        rows = self.scratch.saved(
            postings.join(parts.select("gid", "part").distinct(), "gid"), "posted-parts"
        )
        tokens = rows.groupBy("token", "part").agg(F.count("*").alias("rows"))
        tokens = (
            tokens.groupBy("token")
            .agg(F.max(F.struct("rows", "part")).alias("top"), F.count("*").alias("parts"))
            .where("parts > 1")
            .select("token", F.col("top.part").alias("largest"))
        )
        rows = self.scratch.saved(
            rows.join(self.scratch.saved(tokens, "mixed"), "token"), "mixed-rows"
        )
        smaller = rows.where("part <> largest")
        pairs = (
            smaller.alias("x").join(rows.alias("y"), "token")
            .where((F.col("x.part") != F.col("y.part")) & self._may_link("x", "y"))
            .select(
                F.least(F.struct("x.gid", "x.part"), F.struct("y.gid", "y.part")).alias("p"),
                F.greatest(F.struct("x.gid", "x.part"), F.struct("y.gid", "y.part")).alias("q"),
            )
            .distinct()
            .select(
                F.col("p.gid").alias("ga"), F.col("p.part").alias("pa"),
                F.col("q.gid").alias("gb"), F.col("q.part").alias("pb"),
            )
        )
        pairs = self._roomy(pairs, postings, "rest")
        return (
            pairs.join(parts.toDF("ga", "a", "pa"), ["ga", "pa"])
            .join(parts.toDF("gb", "b", "pb"), ["gb", "pb"])
            .select("a", "b")
        )

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs that link, by their whole sets."""
        pairs = self.scratch.saved(pairs, f"{name}-members")
        self.scratch.drop(f"{name}-pairs")
        grams = self._grams_of(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), name)
        left = grams.select(F.col("sid").alias("a"), F.col("grams").alias("ga"))
        right = grams.select(F.col("sid").alias("b"), F.col("grams").alias("gb"))
        shared = F.size(F.array_intersect("ga", "gb"))
        links = self.scratch.saved(
            pairs.join(right, "b").join(left, "a")
            .select("a", "b", (F.size("ga") + F.size("gb")).alias("sizes"), shared.alias("shared"))
            .where(F.col("shared") * 100 >= (F.col("sizes") - F.col("shared")) * self.percent),
            name,
        )
        self.scratch.drop(f"{name}-members", f"{name}-grams")
        return links

    def _named_links(self) -> DataFrame:
        ids = self.sets.select("sid", "least_id")
        pair = F.sort_array(F.array("x", "y"))  # a null id comes first
        return (
            self._links.join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b")
            .select(pair[0].alias("id_a"), pair[1].alias("id_b"), "shared")
        )

    def links(self) -> DataFrame:
        """Every link between different sets, once: id_a, id_b (their smallest ids), shared.

        Documents of equal sets link too; `components()` counts them.
        """
        if not self.whole:
            raise ValueError("all links are known only with whole=True")
        return self._named_links()

    def spanning_links(self) -> DataFrame:
        """Links that connect each component, each once; others inside it may be missing."""
        return self._named_links().distinct()

    def _link_counts(self) -> DataFrame:
        """(n, s1, s2, n_links): the documents that one of this set links with, itself left out."""
        copies = (
            self.signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.count("*").alias("copies"))
            .join(self.sets.select("n", "s1", "s2", "sid"), ["n", "s1", "s2"])
        )
        copies = self.scratch.saved(copies, "copies")
        both = self._links.select("a", "b").union(self._links.select("b", "a")).toDF("sid", "with")
        others = both.join(copies.select(F.col("sid").alias("with"), F.col("copies").alias("of")), "with")
        others = others.groupBy("sid").agg(F.sum("of").alias("others"))
        n_links = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
        return copies.join(others, "sid", "left").select("n", "s1", "s2", n_links.alias("n_links"))

    def _labelled(self) -> DataFrame:
        labelled = self.sets.select("n", "s1", "s2", "sid", "least_id", "one").join(
            self.labels.withColumnRenamed("v", "sid"), "sid", "left"
        )
        return self.scratch.saved(labelled.withColumn("c", F.coalesce("c", "sid")), "labelled")

    def representatives(self, docs: DataFrame) -> DataFrame:
        """The rows of the joined table without all but one document of each component.

        The one with the smallest id stays, and all that have no shingles.
        """
        digest, i, key = unused(docs.columns, "digest", "id", "key")
        kept = self._labelled().groupBy("c").agg(F.min("one").alias("one"))
        kept = kept.select(F.col("one.doc_id").alias(i), F.col("one.text_key").alias(key)).union(
            self.signed.where("n = 0").select("doc_id", "text_key").distinct()
        )
        kept = self.scratch.saved(kept, "kept")
        text = F.col(f"`{self.text_col}`")
        rows = docs.withColumn(digest, F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
        rows = rows.join(
            kept,
            (F.col(digest) == F.col(key)) & F.col(f"`{self.id_col}`").eqNullSafe(F.col(i)),
            "left_semi",
        )
        again = self.signed.where("n > 0").groupBy("doc_id", "text_key").count().where("count > 1")
        if not again.isEmpty():  # rows that repeat id and text
            full = rows.where(~text.rlike(r"[^\x20\x09-\x0D]") | text.isNull())
            rest = rows.where(text.rlike(r"[^\x20\x09-\x0D]"))
            rows = full.unionByName(rest.dropDuplicates([self.id_col, digest]))
        return rows.drop(digest)

    def release(self) -> None:
        """Remove the scratch tables but those that rows of `representatives` come from.

        Other results can't be had from this join afterwards.
        """
        self.scratch.keep("kept")

    def components(self) -> DataFrame:
        """doc_id, n_shingles, component_id: one row per row of the table.

        With `whole` n_links follows, the number of other documents that it links with.
        """
        labelled = self._labelled()
        least = self.scratch.saved(
            labelled.groupBy("c").agg(F.min("least_id").alias("component_id")), "least"
        )
        named = labelled.join(least, "c").select("n", "s1", "s2", "component_id")
        if self.whole:
            named = named.join(self._link_counts(), ["n", "s1", "s2"])
        rows = self.signed.select("doc_id", "n", "s1", "s2").join(
            self.scratch.saved(named, "named"), ["n", "s1", "s2"], "left"
        )
        counts = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if self.whole else []
        return rows.select(
            "doc_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
            .alias("component_id"),
            *counts,
        )


def ngram_jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    return GroupedPrefixJoin(docs, k, percent).components()
