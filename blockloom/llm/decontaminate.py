"""Benchmark passages in training documents, by a positional inverted index.

DataFrame functions only. Training tokens become postings (term, document, position);
an item's window matches where postings of its terms stand at the window's offsets.

1. Postings of the items' terms are counted, which ranks the terms by rarity.
2. Of every window the ``LISTS`` rarest terms are looked up. A posting minus the
   term's offset in the item is an alignment (document, item, shift); the lists are
   intersected on it, counted per document before anything is shuffled.
3. Alignments that all lists of some window share go back to their documents, where
   all words of the item are compared in place. What remains is exact.

Items' terms are broadcast if they are counted to be few; otherwise they are joined
by shuffles, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.shared import ascii_lower, computed, settle

WINDOW = 13
#: Rarest terms of a window that are looked up before its words are compared.
LISTS = 2
#: Rows of a side that is broadcast, at most: some tens of bytes each.
BROADCAST_ROWS = 200_000

_MATCHES = (
    "array<struct<ids:array<string>,shift:int,width:int,"
    "phrase_starts:array<int>,near_starts:array<int>>>"
)

#: Everything of ASCII but letters and digits parts words.
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The lower-cased words of ``text``, none for NULL."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), PARTING), "")


def _small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _key() -> Column:
    """A key by which candidates find their row again. Rows that share a key share
    candidates, which is harmless, as every row compares its own words."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))


def _postings(docs: DataFrame) -> DataFrame:
    return docs.select(_key().alias("key"), F.posexplode(words(F.col("text"))).alias("pos", "term"))


def item_table(items: DataFrame) -> DataFrame:
    """Distinct word sequences of the items: item (a digest), ids, terms. Items
    without words can't occur and are left out."""
    split = items.select("item_id", words(F.col("text")).alias("terms")).filter(F.size("terms") > 0)
    named = split.withColumn("item", F.md5(F.array_join("terms", " ")))
    return named.groupBy("item").agg(
        F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("ids"),
        F.first("terms").alias("terms"),
    )


def rarest(table: DataFrame, counts: DataFrame, window: int, lists: int) -> DataFrame:
    """item, offset, term, group, rank: the ``lists`` rarest terms of every window.

    Windows with the same rarest offsets are one group.
    """
    terms = table.select("item", F.posexplode("terms").alias("offset", "term"))
    ranked = (
        terms.join(counts, "term", "left")
        .groupBy("item")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("offset", F.coalesce("n", F.lit(0)).alias("n"), "term"))
            ).alias("all")
        )
        .withColumn("all", F.transform("all", lambda x: F.struct(x["n"], x["offset"], x["term"])))
    )
    width = F.least(F.lit(window), F.size("all"))
    starts = F.sequence(F.lit(1), F.size("all") - width + 1)
    picked = F.transform(
        starts, lambda s: F.slice(F.sort_array(F.slice(F.col("all"), s, width)), 1, lists)
    )
    groups = computed(ranked).select("item", F.explode(F.array_distinct(picked)).alias("picked"))
    return groups.select(
        "item",
        F.transform("picked", lambda x: x["offset"]).alias("group"),
        F.posexplode("picked").alias("rank", "x"),
    ).select("item", "group", "rank", F.col("x.offset").alias("offset"), F.col("x.term").alias("term"))


def alignments(docs: DataFrame, table: DataFrame, window: int, lists: int) -> DataFrame:
    """key, item, shift: where the rarest terms of some window of an item all stand."""
    vocabulary = _small(table.select(F.explode("terms").alias("term")).distinct())
    postings = _postings(docs)
    counts = postings.join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))
    looked_up = settle(rarest(table, counts, window, lists))
    hits = postings.join(_small(looked_up), "term").select(
        "key", "item", (F.col("pos") - F.col("offset")).alias("shift"), "group", "rank"
    )
    met = hits.groupBy("key", "item", "shift", "group").agg(
        F.bit_or(F.expr("shiftleft(1, rank)")).alias("lists"), F.first(F.size("group")).alias("n")
    )
    whole = F.expr("lists = shiftleft(1, n) - 1")
    return met.filter(whole).select("key", "item", "shift").distinct()


def _in_place(doc: Column, item: Column, shift: Column) -> Column:
    """Text of 1 and 0: whether each word of the item stands at its place."""
    n = F.size(item)
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.when(
                (shift + k >= 0)
                & (shift + k < F.size(doc))
                & (F.get(doc, (shift + k).cast("int")) == F.get(item, k)),
                "1",
            ).otherwise("0"),
        ),
        "",
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    near: int = 10,
    lists: int = LISTS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns, n_words, and
    ``matches``, an array of ids, shift, width, phrase_starts and near_starts.

    A phrase start is a word position in the document where ``window`` consecutive
    words of the item stand; items of fewer words are one window. A near start is a
    position where, without being a phrase, at least ``near`` of the window's words
    stand in place (all but ``window - near`` for shorter items), among them the
    ``lists`` rarest words of some window of the item. ``shift`` is the document
    position of the item's first word. Items that don't occur are not listed. NULL,
    empty and wordless texts have no words and no matches; a NULL item_id is listed
    as an empty text; repeated rows are all returned. A carried column named like a
    result gives way to it; other columns are dropped.
    """
    carry = tuple(c for c in carry if c not in ("doc_id", "n_words", "matches"))
    rest = F.struct("doc_id", *carry).alias("rest")
    table = settle(item_table(items))
    found = alignments(docs, table, window, lists)
    found = found.join(table, "item").groupBy("key").agg(
        F.collect_list(F.struct("ids", "shift", "terms")).alias("found")
    )
    keyed = docs.select(rest, "text", _key().alias("key"))
    both = keyed.join(found, "key", "left").select(
        "rest", words(F.col("text")).alias("words"), "found"
    )
    both = computed(both)

    def starts(x: Column, flags: Column, width: Column, least: Column, most: Column) -> Column:
        def counted(k: Column) -> Column:
            return F.length(F.replace(F.substring(flags, k + 1, width), F.lit("0"), F.lit("")))

        return F.transform(
            F.filter(
                F.sequence(F.lit(0), F.size(x["terms"]) - width),
                lambda k: counted(k).between(least, most),
            ),
            lambda k: k + x["shift"],
        )

    def matched(x: Column) -> Column:
        flags = _in_place(F.col("words"), x["terms"], x["shift"])
        same = (x[name].alias(name) for name in ("ids", "shift", "terms"))
        return F.struct(*same, flags.alias("flags"))

    def judged(x: Column) -> Column:
        width = F.least(F.lit(window), F.size(x["terms"]))
        return F.struct(
            x["ids"].alias("ids"),
            x["shift"].alias("shift"),
            width.alias("width"),
            starts(x, x["flags"], width, width, width).alias("phrase_starts"),
            starts(x, x["flags"], width, width - (window - near), width - 1).alias("near_starts"),
        )

    found = F.filter(
        F.transform(F.transform("found", matched), judged),
        lambda m: (F.size(m["phrase_starts"]) > 0) | (F.size(m["near_starts"]) > 0),
    )
    matches = F.when(F.col("found").isNull(), F.array().cast(_MATCHES)).otherwise(found)
    return both.select(
        *(F.col("rest")[c].alias(c) for c in ("doc_id", *carry)),
        F.size("words").cast("bigint").alias("n_words"),
        matches.alias("matches"),
    )


def contamination(
    docs: DataFrame, items: DataFrame, carry: tuple[str, ...] = (), **options
) -> DataFrame:
    """Per row of ``docs``: doc_id, the ``carry`` columns, n_words, n_hit (words inside
    phrases), items (the ids that occur, sorted as text), near_items and contaminated:
    a word is hit, and at least a twentieth of all words are."""
    results = ("doc_id", "n_words", "matches", "n_hit", "items", "near_items", "contaminated")
    carry = tuple(c for c in carry if c not in results)
    phrases = F.filter("matches", lambda m: F.size(m["phrase_starts"]) > 0)
    hit = F.flatten(
        F.transform(
            phrases,
            lambda m: F.flatten(
                F.transform(m["phrase_starts"], lambda s: F.sequence(s, s + m["width"] - 1))
            ),
        )
    )
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(phrases, lambda m: m["ids"]))))
    near = F.filter("matches", lambda m: F.size(m["near_starts"]) > 0)
    near_ids = F.array_sort(F.array_distinct(F.flatten(F.transform(near, lambda m: m["ids"]))))
    counted = occurrences(docs, items, carry=carry, **options).select(
        "doc_id",
        *carry,
        "n_words",
        F.size(F.array_distinct(hit)).cast("bigint").alias("n_hit"),
        ids.alias("items"),
        near_ids.alias("near_items"),
    )
    return counted.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
