"""Duplicates hidden by formatting differences (problem 2).

``collapse_copies`` finds the texts that differ at most in white space, punctuation, letter case and
word order, by progressive partition refinement. Each step only looks inside the classes that the
step before left with several members: stripped length and letter histogram split the distinct texts
into classes, classes with several texts are collapsed to forms, and only classes with several forms
get the costlier keys (sorted words, joined words, words with one neighbouring pair joined), along
which sameness is carried over until nothing changes; classes that stay split also get the keys of
all ways to join neighbouring words. Names of more than MANY_WORDS words have too many ways; in the
classes that stay split they are held against each other name by ``joined_alike``, with the same outcome.

Defined results: null texts, and texts without a letter or digit, are copies of nothing; an id that
occurs in several rows is one id, and if its texts differ it ties their classes together; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.runtime import cut, forget
from ledgerloom.skew import join_counted, join_unique

#: Most words of a name all of whose ways to join neighbours become keys (they double with each word); longer ones are compared.
MANY_WORDS = 14


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _sorted(words: Column) -> Column:
    return F.array_join(F.array_sort(words), " ")


def _letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]", "")


def _histogram(letters: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(F.split(letters, "")), ""))


def _forms(texts: DataFrame) -> DataFrame:
    """Adds tight_words (punctuation removed) and loose_words (punctuation as white space), in order, and
    tight and loose, the same sorted."""
    low = F.regexp_replace(F.lower("text"), r"[\s\p{Z}\x{200B}\x{FEFF}]+", " ")
    texts = texts.withColumn("_low", low)
    texts = texts.withColumn("tight_words", _words(F.regexp_replace("_low", r"[^\p{L}\p{M}\p{N}\s]", "")))
    texts = texts.withColumn("loose_words", _words(F.regexp_replace("_low", r"[^\p{L}\p{M}\p{N}\s]", " "))).drop("_low")
    return texts.withColumn("tight", _sorted(F.col("tight_words"))).withColumn("loose", _sorted(F.col("loose_words")))


def _pairs_joined(words: Column) -> Column:
    """Sorted words of every form in which one neighbouring pair of words is written together."""
    return F.when(
        F.size(words) >= 2,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: _sorted(
                F.concat(
                    F.slice(words, F.lit(1), i - 1),
                    F.array(F.concat(F.element_at(words, i), F.element_at(words, i + 1))),
                    F.slice(words, i + 2, F.size(words)),
                )
            ),
        ),
    ).otherwise(F.array().cast("array<string>"))


def _all_joined(words: Column) -> Column:
    """Sorted words of every form in which neighbouring words are written together, in any number of
    places: the ways of a name double with each word, so only names that stay split come here."""
    one = lambda w: F.array(F.array(w))
    last = lambda way: F.element_at(way, -1)
    grown = lambda ways, w: F.concat(
        F.transform(ways, lambda way: F.concat(way, F.array(w))),
        F.transform(ways, lambda way: F.concat(F.slice(way, F.lit(1), F.size(way) - 1), F.array(F.concat(last(way), w)))),
    )
    rest = F.slice(words, F.lit(2), F.size(words))
    ways = F.aggregate(rest, one(F.element_at(words, 1)), grown)
    return F.when(F.size(words).between(1, MANY_WORDS), F.array_distinct(F.transform(ways, _sorted))).otherwise(F.array().cast("array<string>"))


def _same_runs(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[set, set]:
    """Runs (start, end, letters) of words of a and of b that spell the same and have no boundary inside in
    common: from each two words on there is one at most. If a and b have a form in common, they have one
    of such runs alone, for any others fall apart at the common boundaries."""
    at, mine, other = defaultdict(list), set(), set()
    for k, w in enumerate(b):
        at[w[0]].append(k)
    for i in range(len(a)):
        for k in at[a[i][0]]:
            x, y, j, m = a[i], b[k], i + 1, k + 1
            while len(x) != len(y):
                if len(x) < len(y) and j < len(a) and y.startswith(x):
                    x, j = x + a[j], j + 1
                elif len(x) > len(y) and m < len(b) and x.startswith(y):
                    y, m = y + b[m], m + 1
                else:
                    break
            if x == y:
                mine.add((i, j, x))
                other.add((k, m, x))
    return mine, other


def _fillings(runs: list, most: Counter) -> set[tuple]:
    """All sorted lists of letters of runs that fill their places without overlap, each no oftener than ``most``."""
    at, starts = sorted({p for i, j, _ in runs for p in range(i, j)}), defaultdict(list)
    for i, j, x in runs:
        starts[i].append((bisect_left(at, j), x))
    ways = [set() for _ in range(len(at) + 1)]
    ways[0].add(())
    for n, i in enumerate(at):
        for way in ways[n]:
            for after, x in starts[i]:
                if way.count(x) < most[x]:
                    longer = list(way)
                    insort(longer, x)
                    ways[after].add(tuple(longer))
        ways[n] = None
    return ways[-1]


def joined_alike(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether words of a and of b, neighbours written together in any number of places, are the same but for order.

    The names fall into parts that have neither words nor letters of runs in common, mostly single words; ways
    are tried inside a part only, and equal lists of runs once."""
    mine, other = _same_runs(a, b)
    if len({p for i, j, _ in mine for p in range(i, j)}) < len(a) or len({p for k, m, _ in other for p in range(k, m)}) < len(b):
        return False
    above: dict = {}

    def top(x):
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for side, runs in enumerate((mine, other)):
        for i, j, x in runs:
            for p in range(i, j):
                above[top((side, p))] = top(x)
    parts = defaultdict(lambda: ([], []))
    for side, runs in enumerate((mine, other)):
        for run in runs:
            parts[top(run[2])][side].append(run)
    count = lambda runs: Counter(x for *_, x in runs)
    return all(_fillings(m, count(o)) & _fillings(o, count(m)) for m, o in parts.values())


def _long_alike(names: pd.DataFrame) -> pd.DataFrame:
    """(node, key) of the names of one class, labelled apart, that are joined alike; one of two has more than MANY_WORDS words."""
    rows = sorted({(r.label, r.node, tuple(r.words)) for r in names.itertuples()}, key=lambda r: -len(r[2]))
    above, out = {r[0]: r[0] for r in rows}, []

    def top(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for n, (label, node, words) in enumerate(rows):
        if len(words) <= MANY_WORDS:
            break
        for other, node_b, words_b in rows[n + 1 :]:
            if top(label) != top(other) and joined_alike(words, words_b):
                above[top(label)] = top(other)
                out += [(node, f"p:{node}:{node_b}"), (node_b, f"p:{node}:{node_b}")]
    return pd.DataFrame(out, columns=["node", "key"], dtype="object")


def carry_over(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, label): the smallest node in each component of a (node, key) bipartite graph.

    Every round a node learns the least label its keys hold, the node it is labelled with learns the
    least that any of its followers learnt, and labels are replaced by their own label, so that
    paths halve: the number of rounds grows with the logarithm of the longest chain. Edges and
    labels stay distributed, each step is a hash aggregate or a join with one row for each key, and
    a round's tables are removed once the next stands. rounds, if given, takes the number of rounds.
    """
    edges = cut(edges.select("node", "key").distinct())
    labels = cut(edges.select("node").distinct().withColumn("label", F.col("node")))
    total, n = edges.count(), 0
    while True:
        n += 1
        by_key = join_unique(edges, labels, ["node"], total).groupBy("key").agg(F.min("label").alias("least"))
        learnt = join_unique(edges, by_key, ["key"], total).groupBy("node").agg(F.min("least").alias("least"))
        own = labels.join(learnt, "node")
        told = own.groupBy("label").agg(F.min("least").alias("told"))
        new, seen = join_unique(own, told, ["label"], total).select("node", "label", F.least("label", "least", "told").alias("new")), Observation()
        new = cut(new.observe(seen, F.count_if(F.col("new") < F.col("label")).alias("moved")))
        moved = seen.get["moved"]
        if moved:
            up = new.select(F.col("node").alias("new"), F.col("new").alias("above"))
            after = cut(join_unique(new.select("node", "new"), up, ["new"], total).select("node", F.least("new", "above").alias("label")))
        forget(new)
        if not moved:
            forget(edges)
            if rounds is not None:
                rounds.append(n)
            return labels
        forget(labels)
        labels = after


def classed(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, keep_id) of every row with an id and a readable text."""
    named = rows.select(F.trim(F.col(id_col).cast("string")).alias("id"), F.col(text_col).alias("text"))
    named = named.filter(F.col("id").isNotNull() & (F.col("id") != "") & F.col("text").isNotNull())
    # equal texts are one from here on: a text with any number of rows shrinks in the partial aggregate; unreadable ones end here
    texts = named.groupBy("text").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).filter(_letters(F.col("text")) != "")
    # refinement 1: classes by stripped length and letter histogram; texts alone in theirs are done
    letters = _letters(F.col("text"))
    texts = cut(texts.withColumn("shape", F.struct(F.length(letters).alias("length"), _histogram(letters).alias("histogram"))).select("text", "first_id", "n", "shape.*"))
    shape = ["length", "histogram"]
    crowded = texts.groupBy(*shape).agg(F.count("*").alias("members")).filter("members > 1").select(*shape)
    # one id with several texts ties them, whatever their letters
    torn = named.groupBy("id").agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a != b").select("id")
    tied = cut(named.join(torn, "id", "left_semi").select("id", "text").distinct())
    # refinement 2: forms, inside crowded classes only; texts of one form are one node
    inside = join_unique(texts, crowded, shape, texts.count()).select("text", *shape)
    inside = inside.unionByName(texts.join(tied.select("text").distinct(), "text", "left_semi").select("text", *shape)).distinct()
    forms = _forms(inside).withColumn("node", F.sha2(F.concat_ws("\u0001", "tight", "loose"), 256))
    forms = cut(forms.select("text", "node", *shape, "tight", "loose", "tight_words", "loose_words"))
    nodes = forms.groupBy("node").agg(F.min("length").alias("length"), F.min("histogram").alias("histogram"))
    # refinement 3: costlier keys, once for each spelling, inside classes of several forms only
    several = nodes.groupBy(*shape).agg(F.count("*").alias("k")).filter("k > 1").select(*shape)
    spelt = cut(forms.join(several, shape, "left_semi").drop("text").distinct())
    keys = F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("w:"), "tight"), F.concat(F.lit("w:"), "loose"), F.concat(F.lit("j:"), F.array_join("tight_words", ""))),
            F.transform(F.concat(_pairs_joined(F.col("tight_words")), _pairs_joined(F.col("loose_words"))), lambda w: F.concat(F.lit("w:"), w)),
        )
    )
    edges = spelt.select("node", F.explode(keys).alias("key"))
    edges = edges.unionByName(tied.join(forms.select("text", "node"), "text").select("node", F.concat(F.lit("i:"), "id").alias("key")))
    labels = carry_over(edges)
    # refinement 4: classes of equal letters that stay split, all ways to join neighbouring words
    left = spelt.join(labels, "node")
    words = F.max(F.greatest(F.size("tight_words"), F.size("loose_words"))).alias("words")
    split = left.groupBy(*shape).agg((F.min("label") != F.max("label")).alias("split"), words).filter("split").drop("split")
    split = cut(split)
    some, long = split.agg(F.count("*"), F.count_if(F.col("words") > MANY_WORDS)).first()
    if some:
        ways = F.array_distinct(F.concat(_all_joined(F.col("tight_words")), _all_joined(F.col("loose_words"))))
        more = spelt.join(split, shape, "left_semi").select("node", F.explode(F.transform(ways, lambda w: F.concat(F.lit("w:"), w))).alias("key"))
        if long:
            far = left.join(split.filter(F.col("words") > MANY_WORDS), shape, "left_semi")
            far = far.select("node", "label", *shape, F.explode(F.array_distinct(F.array("tight_words", "loose_words"))).alias("words"))
            more = more.unionByName(far.groupBy(*shape).applyInPandas(_long_alike, "node string, key string"))
        labels = carry_over(edges.unionByName(more))
    of = forms.select("text", "node").join(labels, "node", "left").select("text", F.coalesce("label", "node").alias("label"))
    of = texts.join(of, "text", "left").withColumn("label", F.coalesce("label", F.concat(F.lit("t:"), "text")))
    keep = of.groupBy("label").agg(F.min("first_id").alias("keep_id"))
    keep = cut(join_unique(of.select("text", "n", "label"), keep, ["label"], texts.count()).select("text", "n", "keep_id"))
    return join_counted(named, keep, "text", "n").select("id", "text", "keep_id")


def collapse_copies(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, keep_id): for every id with a readable text, the smallest id of its class."""
    return classed(rows, id_col, text_col).select("id", "keep_id").distinct()


def vendor_names(vendors: DataFrame, qbo_vendors: DataFrame) -> DataFrame:
    return vendors.select(F.col("vendor_id").alias("id"), "vendor_name").unionByName(
        qbo_vendors.select(F.col("qbo_vendor_id").alias("id"), "vendor_name")
    )


def vendor_copies(vendors: DataFrame, qbo_vendors: DataFrame) -> DataFrame:
    """(keep_id, copy_id) of the vendors entered under several ids."""
    found = collapse_copies(vendor_names(vendors, qbo_vendors), "id", "vendor_name")
    return found.filter("id != keep_id").select("keep_id", F.col("id").alias("copy_id"))


def vendor_records(vendors: DataFrame, qbo_vendors: DataFrame) -> DataFrame:
    """(keep_id, vendor_name, copies): one record per vendor, its name as entered under keep_id (the least, if
    entered in several ways), and the number of ids it was entered under."""
    each = classed(vendor_names(vendors, qbo_vendors), "id", "vendor_name").groupBy("id", "keep_id").agg(F.min("text").alias("text"))
    return each.groupBy("keep_id").agg(F.min(F.struct("id", "text"))["text"].alias("vendor_name"), F.count("*").alias("copies"))
