"""Groups of spelling variants: words one edit apart, found along a distributed trie.

The words are the paths of a trie whose edges are a table: ``depth, node,
letter, below, leaf, through``. A node is named by its prefix, the empty letter
marks that the node itself is a word, ``below`` counts the words behind an edge,
``leaf`` names the word if it is the only one, and ``through`` counts the words
at the node. States ``word, position, node, edits`` start at the root without
edits and are joined with the edges level by level:

* without edits, a state goes on along its own letter, replaces that letter by
  a larger one, or skips it (the last of a run of equal letters);
* with one edit it goes on along its own letter only, and where the word ends at
  a node that is a word, the two are neighbours;
* an edge with one word behind it ends the walk: what is left of both words is
  compared at once.

Every pair is met once, from the longer word or from the one with the smaller
letter, and mirrored. A level is written before the next starts. Nodes through
which at least 1/200 of all words go, at most 200 a level, are joined by
broadcast; so no key of the shuffled joins owns many states that go on unedited.

Words of more than ``LONG`` code points would make as many levels. Pairs with
such a word are found by equal remainders after one letter is left out, and
compared in full.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import shared_folder, written

RUN = "[A-Za-zÀ-ÿ]"
LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5
LONG = 64
# A node is hot if one word in so many goes through it.
HOT = 200
DELETE_EVERY = 199

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after(text: str, at: Column) -> Column:
    """What is left of ``text`` from code point ``at`` (from 0) on."""
    return F.substring(text, at + 1, F.length(text))


def _letter(text: str, at: Column) -> Column:
    return F.substring(text, at + 1, F.lit(1))


def perturbed(doc_id: Column, run: Column, every: int = DELETE_EVERY) -> Column:
    """``run``, or in one of ``every`` cases, drawn by checksum, ``run`` without one letter."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def count_words(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
    every: int = DELETE_EVERY,
) -> DataFrame:
    """``word, n``: the words of all texts with their occurrences.

    Runs of letters are lower-cased (A-Z) and perturbed. Runs that are too short
    are not taken out of the text at all, as no deletion makes them longer.
    """
    runs = docs.select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least_chars},}}"), F.lit(0))).alias("run")
    )
    lowered = runs.select("doc_id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    # A generator, so that the filter below does not work the words out once more.
    words = lowered.select(F.explode(F.array(perturbed(F.col("doc_id"), F.col("run"), every))).alias("word"))
    counted = words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def trie_edges(words: DataFrame) -> DataFrame:
    """The edges of the trie of ``word``, below nodes that at least two words go through."""
    steps = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth")).select(
        "depth",
        F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        _letter("word", F.col("depth")).alias("letter"),
        "word",
    )
    edges = steps.groupBy("depth", "node", "letter").agg(
        F.count(F.lit(1)).alias("below"), F.min("word").alias("leaf")
    )
    through = edges.groupBy("node").agg(F.sum("below").alias("through")).where("through > 1")
    return edges.join(through, "node").select(
        "depth", "node", "letter", "below", F.when(F.col("below") == 1, F.col("leaf")).alias("leaf"), "through"
    )


def _moves(states: DataFrame, edges: DataFrame, edits: int) -> DataFrame:
    """What states of ``edits`` become along ``edges``: ``word, position, node, edits, found``.

    Without edits every letter of a state's node is looked at, with one only the state's own.
    """
    own, after = _letter("word", F.col("position")), _letter("word", F.col("position") + 1)
    letter, only = F.col("letter"), F.col("below") == 1
    child = F.concat("node", "letter")

    def past(steps: int, found: Column) -> Column:
        """An edited state past the edge, or null if the one word behind it goes on otherwise."""
        position = F.col("position") + steps
        equal = _after("leaf", F.length("node") + F.length("letter")) == _after("word", position)
        return F.when(
            ~only | equal,
            F.struct(
                position.alias("position"), child.alias("node"), F.lit(1).alias("edits"),
                F.coalesce(found, F.when(only, F.col("leaf"))).alias("found"),
            ),
        )

    none = F.lit(None).cast("string")
    at_end = F.when(letter == "", F.col("node"))
    if edits:
        joined = states.withColumn("letter", own).join(edges, ["node", "letter"])
        became = [past(1, at_end)]
    else:
        joined = states.withColumns({"own": own, "after": after}).join(edges, "node")
        joined = joined.where("letter > own and own <> '' or letter = own or letter = after and own <> after")
        on = F.struct(
            (F.col("position") + 1).alias("position"), child.alias("node"), F.lit(0).alias("edits"), none.alias("found")
        )
        became = [
            F.when((letter == F.col("own")) & (letter != "") & ~only, on),
            F.when((letter > F.col("own")) & (F.col("own") != ""), past(1, none)),
            # The empty letter behind the last one: there the shorter word is the node itself.
            F.when((letter == F.col("after")) & (F.col("own") != F.col("after")), past(2, at_end)),
        ]
    return joined.select("word", F.inline(F.array(*became))).where("edits is not null")


def trie_neighbours(words: DataFrame) -> DataFrame:
    """``a, b``: the pairs of ``word`` (distinct) that are one edit apart, each once."""
    spark, total = words.sparkSession, words.count()
    warm = F.col("through") * HOT >= total
    edges = written(trie_edges(words).withColumn("hot", warm).sortWithinPartitions("depth"), "edges")
    kinds = {(r.depth, r.hot) for r in edges.select("depth", "hot").distinct().collect()}
    path = shared_folder(spark, "levels")
    # The root by the word itself: a constant would make the join one without a key.
    root = F.substring("word", F.lit(1), F.lit(0))
    states = words.select("word", F.lit(0).alias("position"), root.alias("node"), F.lit(0).alias("edits"))
    schema = states.select("*", F.col("word").alias("found")).schema
    levels = 0
    while {(levels, True), (levels, False)} & kinds:
        level = edges.where(F.col("depth") == levels)
        parts, rest = [], states
        if (levels, True) in kinds:
            # At most HOT nodes of one depth, with as many edges each as there are letters.
            hot = level.where("hot").select("node", "letter", "below", "leaf")
            parts = [(states, F.broadcast(hot))]
            rest = states.join(F.broadcast(hot.select("node").distinct()), "node", "left_anti")
        if (levels, False) in kinds:
            parts.append((rest, level.where("not hot").select("node", "letter", "below", "leaf")))
        moved = [_moves(s.where(F.col("edits") == e), side, e) for s, side in parts for e in (0, 1)[: levels + 1]]
        reduce(DataFrame.unionByName, moved).select(schema.names).write.parquet(f"{path}/depth={levels}")
        states = spark.read.schema(schema).parquet(f"{path}/depth={levels}").where("found is null").drop("found")
        levels += 1
    if not levels:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    found = spark.read.schema(schema).parquet(path).where("found is not null")
    return found.select(F.col("word").alias("a"), F.col("found").alias("b"))


def long_neighbours(words: DataFrame, beyond: int = LONG) -> DataFrame:
    """``a, b``: the pairs one edit apart of which one has more than ``beyond`` code points.

    One row a letter carries the checksum of the word without it, not the word.
    """
    whole = words.where(F.length("word") >= beyond).select("word", F.xxhash64("word").alias("id"))
    without = F.concat(F.substring("word", F.lit(1), F.col("at")), _after("word", F.col("at") + 1))
    cut = whole.withColumn("at", F.explode(F.sequence(F.lit(0), F.length("word") - 1))).select(
        "id", "at", F.length("word").alias("chars"), F.xxhash64(without).alias("rest")
    )
    other = cut.withColumnRenamed("id", "other")
    replaced = cut.join(other, ["rest", "at", "chars"]).where("id < other").select("id", "other", "at", F.lit(1).alias("kept"))
    shorter = whole.select(F.col("id").alias("other"), F.col("id").alias("rest"), F.length("word").alias("less"))
    dropped = cut.join(shorter, "rest").where("less = chars - 1").select("id", "other", "at", F.lit(0).alias("kept"))
    names = whole.select(F.col("word").alias("b"), F.col("id").alias("other"))
    both = replaced.unionByName(dropped).join(whole.withColumnRenamed("word", "a"), "id").join(names, "other")
    same = (F.substring("a", F.lit(1), F.col("at")) == F.substring("b", F.lit(1), F.col("at"))) & (
        _after("a", F.col("at") + 1) == _after("b", F.col("at") + F.col("kept"))
    )
    return both.where(same & (F.greatest(F.length("a"), F.length("b")) > beyond) & (F.col("a") != F.col("b"))).select(
        "a", "b"
    ).distinct()


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: every word of ``word`` (distinct) with each word one edit away."""
    pairs = trie_neighbours(words.where(F.length("word") <= LONG))
    if not words.where(F.length("word") > LONG).isEmpty():
        pairs = pairs.unionByName(long_neighbours(words))
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")),
    )
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: forms followed to their end by doubling the step.

    A form has several times its word's occurrences, so there are no circles and
    the chains are short.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(now.join(further, "root", "left"), "roots")
        now = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next is not null").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, every: int = DELETE_EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts of ``docs``.

    A word's form is its neighbour of the most occurrences (of equally many the
    smallest in code-point order), if that has at least ``ratio`` times as many
    as the word. The root is where the forms lead in the end. Null texts have no
    words, null ids count as empty when letters are deleted, rows that repeat an
    id count each. An empty table gives no rows. Other columns are not read.
    """
    words = written(count_words(docs.select("doc_id", "text"), least_chars, least_count, every), "words")
    near = neighbours(words.select("word")).join(
        words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near"
    )
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    enough = -F.col("best.less") >= F.col("n") * ratio
    formed = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
