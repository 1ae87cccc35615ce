"""Matching entities across sources that share no identifier (problem 1).

``match_entities`` runs a deterministic rule cascade over titles that may hold a number. Every rule
is an exact equi-join on one combination of attributes, strongest first; titles resolved by a rule
leave the pool by an anti-join before the next, weaker rule runs. A rule resolves a title only if
its key names a single target, so no key can emit more rows than there are titles.

Nothing about the titles' language is built in but what a phase is. The rest comes from the data:

* common words are those that many target titles hold; the others are rare and tell targets apart;
* short forms are learned from the pairs that share a number, or a rare word of one target: a word of the record's title stands
  for the target's common words that its title lacks, if it is made of their letters in order or of
  their initials, or if it never comes without them;
* a number is any run of letters and digits with three digits or more that some target has as its number.

Confidence is a rule's labelled precision with smoothing. Labels are given, or else silver: titles
that share a number with one target are labelled with it, and go through the title rules with their
number hidden, so those are judged on what they neither joined on nor filtered by; the number rule
is judged on the same titles by where the title rules send them. The rule of misspelt numbers is
judged on the rare words, before pairs that contradict are dropped. Two criteria that hold together
and were judged apart leave the product of their errors. A rule with no judged pair stays at the prior.

Defined results: a null, empty or unreadable attribute takes part in no rule that needs it; repeated
landings of one id count once; an empty table on either side gives an empty result; columns other
than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.runtime import cut
from ledgerloom.skew import join_counted, join_salted, join_unique

#: A word is common if this share of the target titles hold it, and COMMON_TITLES of them at least.
#: So there are at most (words of a title) / COMMON_SHARE common words, whatever the input's size.
COMMON_SHARE, COMMON_TITLES = 0.005, 4
#: A short form stands for words that this share of its labelled titles lack; without likeness in letters, that stricter share.
SHORT_SURE, SHORT_BLIND = 0.5, 0.9
#: Short forms are learned from titles of no more words than this.
LABELLED_WORDS = 40
#: Letters that a misspelt word, and letters and digits that a misspelt number, must have.
NEAR_WORD, NEAR_NUMBER = 4, 6

# How a phase is written.
PHASE = r"\bph(?:ase)?[. ]*(iv|iii|ii|[2-9])\b"
ROMAN = {"ii": "2", "iii": "3", "iv": "4"}
# Fixed value: letters or digits joined by one sign, with at most one word of four letters before.
CHUNK = r"(?<![\p{L}\p{N}])(?:\p{L}{1,4}[\-./])?[\p{L}]{0,4}\p{N}[\p{L}\p{N}]*(?:[\-./]\p{N}[\p{L}\p{N}]*)*"


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\P{N}", ""))


def code_of(chunk: Column) -> Column:
    """Letters and digits of a number, a year of four digits at its start shortened to two; null below three digits."""
    short = F.regexp_replace(F.lower(F.trim(chunk)), r"^20([0-4]\p{N})(?=[\-./ ])", "$1")
    code = F.regexp_replace(short, r"[^\p{L}\p{N}]", "")
    return F.when(_digits(code) >= 3, code)


def codes_in(text: Column) -> Column:
    """Every way to read a number in a text: its chunks, two or three neighbours that blanks separate,
    each with the short word before it or without, and with a leading year of four digits shortened."""
    text = F.regexp_replace(text, r"(?<=\p{N})[ ]+(?=\p{N})", " ")
    chunks = F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))
    runs = F.regexp_extract_all(text, F.lit(rf"{CHUNK}(?: \p{{N}}[\p{{N}}\-./]*)+"), F.lit(0))
    several = F.flatten(F.transform(runs, lambda r: _windows(F.split(r, " "))))
    bare = F.transform(chunks, lambda c: F.regexp_extract(c, r"\p{N}.*$", 0))
    worded = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])\p{{L}}{{1,4}} \p{{N}}[\p{{L}}\p{{N}}\-./]*"), F.lit(0))
    found = F.transform(F.concat(chunks, bare, several, worded), code_of)
    glued = F.transform(F.filter(found, lambda c: c.rlike(r"^20[0-4]\p{N}{6,}$")), lambda c: F.substring(c, 3, 100))
    return F.array_distinct(F.filter(F.concat(found, glued), lambda c: c.isNotNull()))


def _windows(parts: Column) -> Column:
    at = F.sequence(F.lit(1), F.size(parts))
    return F.flatten(F.transform(at, lambda i: F.transform(F.array(F.lit(2), F.lit(3)), lambda n: F.array_join(F.slice(parts, i, n), " "))))


def words_of(text: Column) -> Column:
    """Words in order, once each: letters only, signs inside a word dropped, plurals without their s."""
    for pattern, put in (
        (r"(?<=\s)-|-(?=\s)", " "), (r"[\p{L}\p{N}'/\-]*\p{N}[\p{L}\p{N}'/\-]*", " "), (r"(?<=\p{L})['/\-]+(?=\p{L})", ""), (r"\P{L}+", " "), (r"(?<=\p{L}{3}[\p{L}&&[^s]])s(?!\p{L})", ""),
    ):
        text = F.regexp_replace(text, pattern, put)
    return F.filter(F.array_distinct(F.split(F.trim(text), " ")), lambda w: w != "")


def parsed(rows: DataFrame, title: str, number: str | None = None) -> DataFrame:
    """Adds codes, phase and words of a title and an optional separate number."""
    text = F.regexp_replace(F.lower(F.coalesce(F.col(title), F.lit(""))), r"[_\s\p{Z}]+", " ")
    own = F.lit(None).cast("string") if number is None else code_of(F.col(number))
    phase = F.regexp_extract(text, PHASE, 1)
    told = reduce(lambda c, r: c.when(phase == r, ROMAN[r]), ROMAN, F.when(phase == "", None)).otherwise(phase)
    tail = F.regexp_extract(text if number is None else F.concat_ws(" ", F.lower(F.trim(F.col(number))), text), r"\p{N}[\-./ ]\p{N}{3,}[\-./](\p{N})(?![\p{L}\p{N}\-./])", 1)
    return rows.select(
        "*",
        F.when(own.isNotNull(), F.array(own)).when(text.rlike(r"\p{N}.*\p{N}.*\p{N}"), codes_in(text)).otherwise(F.array().cast("array<string>")).alias("codes"),
        F.coalesce(told, F.nullif(tail, F.lit("")), F.lit("1")).cast("int").alias("phase"),
        ((phase != "") | (tail != "")).alias("phased"),
        words_of(F.regexp_replace(text, PHASE, " ")).alias("words"),
    )


def _literal(mapping: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(mapping)), f"map<string,{kind}>")


def common_words(targets: DataFrame) -> dict[str, int]:
    """Words that many target titles hold, with how many do."""
    n = targets.count()
    least = max(COMMON_TITLES, n * COMMON_SHARE)
    each = targets.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return {r.w: r.n for r in each.filter(F.col("n") >= least).collect()}


def meant(rows: DataFrame, no: str, common: dict[str, int], shorts: DataFrame, total: int) -> DataFrame:
    """Adds common (sorted) and rare: the words with short forms spelled out, and rarest, the commonly
    known word that the fewest target titles hold. no numbers the rows."""
    known = _literal(common, "int")
    held = rows.select(no, F.explode(F.filter("words", lambda w: ~w.isin(*common))).alias("s"))
    held = join_unique(held, shorts, ["s"], 2 * total).groupBy(no).agg(F.map_from_entries(F.collect_list(F.struct("s", "w"))).alias("_short"))
    rows = rows.join(held, no, "left")
    spelt = F.transform("words", lambda w: F.coalesce(F.split(F.try_element_at("_short", w), " "), F.array(w)))
    rows = rows.withColumn("words", F.array_distinct(F.flatten(spelt))).drop("_short")
    rows = rows.withColumn("common", F.array_sort(F.filter("words", lambda w: F.try_element_at(known, w).isNotNull())))
    rows = rows.withColumn("rare", F.filter("words", lambda w: F.try_element_at(known, w).isNull() & (F.length(w) >= 3)))
    least = F.array_min(F.transform("common", lambda w: F.struct(F.try_element_at(known, w).alias("n"), w.alias("w"))))
    return rows.withColumn("rarest", least["w"])


def variants(word: Column) -> Column:
    """The word and every form of it that lacks one character: two words within one insertion,
    deletion, substitution or swap of neighbours share a form, so an equi-join finds them."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )
    return F.when(word.isNotNull(), F.array_distinct(F.concat(F.array(word), cuts)))


def close(a: Column, b: Column) -> Column:
    """Whether two words are within one edit or one swap of neighbours."""
    swap = (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2) & F.arrays_overlap(variants(a), variants(b))
    return (F.levenshtein(a, b, 1) != -1) | F.coalesce(swap, F.lit(False))


#: Hits go by numbers: no of a title, t_no of a target row, and lo and hi, hashes of the least and the
#: greatest id among the rows of one title and number, which are equal where there is only one.
def _one_target(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t_no, lo) of the keys that name a single target."""
    best = keyed.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("t_no").alias("t_no"))
    return best.filter("lo = hi").drop("hi")


def _one_each(hits: DataFrame, by: Column, *keep: str) -> DataFrame:
    """(no, t_no, keep) for each title whose hits of least ``by`` all name one target."""
    best = hits.groupBy("no").agg(F.min(F.struct(by.alias("by"), "lo", "t_no", *keep)).alias("a"), F.max(F.struct((-by).alias("by"), "lo")).alias("z"))
    return best.filter(F.col("a.lo") == F.col("z.lo")).select("no", "a.t_no", *[f"a.{c}" for c in keep])


def _near_in(word: Column, words: Column) -> Column:
    return F.array_contains(words, word) | F.exists(words, lambda w: (F.length(w) >= NEAR_WORD) & close(w, word))


def _head_agrees() -> Column:
    """Some rare word of the target is, or is nearly, a word of the title; null if the target has none."""
    some = F.exists("t_rare", lambda t: _near_in(t, F.col("rare")))
    return F.when(F.size("t_rare") > 0, some)


def _shared() -> Column:
    """Share of the target's common words that the title holds."""
    return F.size(F.array_intersect("common", "t_common")) / F.greatest(F.size("t_common"), F.lit(1))


def _rest_known(word: Column) -> Column:
    """All rare words of the target but ``word``, and but one in four, are words of the title."""
    lost = F.filter("t_rare", lambda t: ~F.array_contains(F.col("words"), t) & (t != word))
    return F.size(lost) <= F.floor((F.size("t_rare") - 1) / 4)


def _number_fits() -> Column:
    """No number of the title contradicts the target's: one is close to it, or none is as long."""
    alike = F.filter("codes", lambda c: F.abs(F.length(c) - F.length("t_code")) <= 1)
    return F.col("t_code").isNull() | (F.size(alike) == 0) | F.exists(alike, lambda c: close(c, F.col("t_code")))


def by_number(titles: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """(no, t_no) of the titles whose longest known number names one target."""
    code = targets.withColumn("code", F.get("codes", F.lit(0))).filter("code is not null")
    keyed = code.groupBy("code").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("t_no").alias("t_no"), F.min("t_phase").alias("t_phase")).filter("lo = hi")
    hits = join_unique(titles.select("no", "phase", "phased", F.explode("codes").alias("code")), keyed, ["code"], total)
    hits = hits.filter("not phased or t_phase is null or phase = t_phase")  # another phase of a project is another project
    return _one_each(hits, -F.length("code"))


def by_rare_word(titles: DataFrame, targets: DataFrame, common: dict[str, int], total: int) -> DataFrame:
    """As by_number, of titles whose longest rare word occurs in one target only: pairs to learn from, not matches."""
    known = _literal(common, "int")
    rare = F.explode(F.filter("words", lambda w: F.try_element_at(known, w).isNull() & (F.length(w) >= 3))).alias("h")
    keyed = _one_target(targets.select("lo", "hi", "t_no", rare), ["h"])
    return _one_each(join_unique(titles.select("no", rare), keyed, ["h"], total), -F.length("h"))


def learn_shorts(pairs: DataFrame, common: dict[str, int]) -> DataFrame:
    """(s, w): short forms and what they stand for (common words joined by blanks), of all pairs that share a
    number or a word of one target. How many other pairs there are makes no difference."""
    pairs = pairs.filter(F.size("words") <= LABELLED_WORDS)
    own = F.filter(F.array_except("words", "t_words"), lambda w: ~w.isin(*common))
    lost = F.filter(F.array_except("t_words", "words"), lambda w: w.isin(*common))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("t_words"), F.lit(1))), lambda i: F.transform(F.array(F.lit(2), F.lit(3)), lambda n: F.slice("t_words", i, n)))
    runs = F.filter(F.flatten(runs), lambda r: (F.size(r) >= 2) & (F.size(F.array_except(r, "lost")) == 0))
    stand = F.concat(F.array(F.lit("")), "lost", F.transform(F.array_distinct(runs), lambda r: F.array_join(r, " ")))
    each = pairs.select("t_words", own.alias("own"), lost.alias("lost")).select("own", F.array_distinct(stand).alias("stand"))
    each = each.select("stand", F.explode("own").alias("s")).select("s", F.explode("stand").alias("w"))
    held = F.max(F.when(F.col("w") == "", F.col("n"))).over(Window.partitionBy("s"))
    counts = each.groupBy("s", "w").agg(F.count("*").alias("n")).withColumn("held", held).filter((F.col("w") != "") & (F.col("n") >= SHORT_SURE * F.col("held")))
    size = F.size(F.split("w", " "))
    counts = counts.withColumn("like", _made_of(F.col("s"), F.col("w")))
    counts = counts.filter(F.col("like") | ((size == 1) & (F.col("n") >= 4) & (F.col("n") >= SHORT_BLIND * F.col("held"))))
    # likeness first, then most titles, then the more words that the same initials explain
    rank = F.struct("like", "n", size.alias("size"), F.transform(F.split("w", ""), lambda c: -F.ascii(c)).alias("order"), "w")
    return counts.groupBy("s").agg(F.max(rank)["w"].alias("w"))


def _made_of(short: Column, stand: Column) -> Column:
    """Whether a short form is the words' initials, or one word's first letter and others of its letters in order."""
    initials = F.array_join(F.transform(F.split(stand, " "), lambda w: F.substring(w, 1, 1)), "")
    step = F.transform(F.split(short, ""), lambda c, i: F.when(i == 0, F.concat(F.lit("^"), c)).otherwise(F.concat(F.lit("[^"), c, F.lit("]*+"), c)))
    one = (F.length(short) < F.length(stand)) & F.rlike(stand, F.array_join(step, ""))
    return F.when(F.contains(stand, F.lit(" ")), short == initials).otherwise(one)


def _key(word: str, rest: Column) -> Column:
    return F.xxhash64(word, rest, "phase").alias("key")


def _seen(hits: DataFrame, titles: DataFrame, targets: DataFrame, *of: str) -> DataFrame:
    """Hits with the named attributes of their titles, and all of their targets."""
    return hits.join(titles.select("no", *of), "no").join(targets.select("t_no", "t_code", "t_common", "t_rare"), "t_no")


def by_title(titles: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """(no, t_no) of titles that share a rare word, all common words and the phase with one target only."""
    rest = lambda common: F.array_join(F.array_remove(common, F.col("h")), " ")
    known = F.when(F.size("t_rare") > 0, F.col("t_rare")).otherwise(F.array_compact(F.array("rarest")))
    keyed = targets.withColumn("h", F.explode(known)).select("lo", "hi", "t_no", _key("h", rest("t_common")))
    own = F.array_compact(F.array_append("rare", F.col("rarest")))
    rows = titles.withColumn("h", F.explode(own)).select("no", _key("h", rest("common")))
    hits = join_unique(rows, _one_target(keyed, ["key"]), ["key"], 4 * total)
    hits = _seen(hits, titles, targets, "codes", "words", "hidden").filter(_rest_known(F.lit("")) & (F.col("hidden").isNotNull() | _number_fits()))
    return _one_each(hits, F.lit(0))


def by_near_title(titles: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """As by_title, with a rare word that is misspelt by one letter or a swap."""
    long = lambda c: F.explode(F.filter(c, lambda w: F.length(w) >= NEAR_WORD))
    keyed = targets.withColumn("t_h", long("t_rare")).withColumn("form", F.explode(variants(F.col("t_h")))).select("lo", "hi", "t_no", "t_h", _key("form", F.array_join("t_common", " ")))
    rows = titles.withColumn("h", long("rare")).withColumn("form", F.explode(variants(F.col("h")))).select("no", "h", _key("form", F.array_join("common", " ")))
    # words of several targets may share a form, so a key can bring as many rows as the word has neighbours
    hits = join_salted(rows, _one_target(keyed, ["key", "t_h"]), "key", total=20 * total).filter(close(F.col("h"), F.col("t_h")))
    hits = _seen(hits, titles, targets, "codes", "words", "hidden").filter(_rest_known(F.col("t_h")) & (F.col("hidden").isNotNull() | _number_fits()))
    return _one_each(hits, F.levenshtein("h", "t_h"))


def by_near_number(titles: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """Titles that share all common words, the phase and, but for a letter or a swap, the number with one target only;
    agrees: whether the rare words do as well."""
    keyed = targets.filter(F.length("t_code") >= NEAR_NUMBER).withColumn("form", F.explode(variants(F.col("t_code")))).select("lo", "hi", "t_no", _key("form", F.array_join("t_common", " ")))
    rows = titles.filter("hidden is null and size(common) > 0").withColumn("code", F.explode(F.filter("codes", lambda c: F.length(c) >= NEAR_NUMBER)))
    rows = rows.withColumn("form", F.explode(variants(F.col("code")))).select("no", "code", _key("form", F.array_join("common", " ")))
    hits = _seen(join_unique(rows, _one_target(keyed, ["key"]), ["key"], 20 * total), titles, targets, "rare")
    hits = hits.filter(close(F.col("code"), F.col("t_code"))).withColumn("agrees", _head_agrees())
    return _one_each(hits, F.levenshtein("code", "t_code"), "agrees")


def match_entities(records: DataFrame, targets: DataFrame, labels: DataFrame | None = None, least: float = 0.5, prior_hits: float = 1.0, prior_misses: float = 1.0) -> DataFrame:
    """(record_id, target_id, rule, confidence) of the matches of confidence ``least`` or more.

    records: record_id, title; targets: target_id, title, number; ids may repeat. labels: pairs
    (record_id, target_id) known to be right, with every record_id that was labelled; a rule's hits
    are then the labelled records that it sent to a known target. Without labels see the module.
    Confidence is (hits + prior_hits) / (judged + prior_hits + prior_misses).
    """
    spark = records.sparkSession
    held = records.filter("record_id is not null and title is not null").select("record_id", F.trim("title").alias("title")).distinct()
    # equal titles are one; hot ones shrink in the partial aggregate
    titles = cut(parsed(held.groupBy("title").agg(F.count("*").alias("n")).withColumn("no", F.monotonically_increasing_id()), "title"))
    named = targets.filter("target_id is not null").groupBy(F.trim("title").alias("title"), F.trim("number").alias("number"))
    named = named.agg(F.min("target_id").alias("t_id"), F.max("target_id").alias("t_last")).withColumn("t_no", F.monotonically_increasing_id())
    named = parsed(named, "title", "number").withColumns({"lo": F.least(F.xxhash64("t_id"), F.xxhash64("t_last")), "hi": F.greatest(F.xxhash64("t_id"), F.xxhash64("t_last"))})
    named = cut(named.withColumn("t_phase", F.when(F.col("phased") | (F.size("words") > 0), F.col("phase"))).drop("title", "number", "t_last"))
    common = common_words(named)
    total = titles.count()

    # rule 1, the number
    pairs = cut(by_number(titles, named, total))
    alike = pairs.unionByName(by_rare_word(titles.join(pairs, "no", "left_anti"), named, common, total))
    alike = titles.select("no", "words").join(alike, "no").join(named.select("t_no", F.col("words").alias("t_words")), "t_no")
    shorts = cut(learn_shorts(alike, common))
    every = cut(meant(titles, "no", common, shorts, total).join(pairs.withColumnRenamed("t_no", "hidden"), "no", "left"))
    t = meant(named, "t_no", common, shorts, total).withColumnsRenamed({"common": "t_common", "rare": "t_rare"}).withColumn("t_code", F.get("codes", F.lit(0)))
    t = cut(t.select("t_no", "t_id", "lo", "hi", "t_code", "phase", "t_common", "t_rare", "rarest"))
    # weaker rules, each on what the one before left over
    title = cut(by_title(every, t, total))
    pool = every.join(title, "no", "left_anti")
    near = cut(by_near_title(pool, t, total))
    pool = pool.join(near, "no", "left_anti")
    digits = cut(by_near_number(pool, t, total))

    # number pairs by how far the titles agree
    ids = t.select("t_no", "t_id")
    told = title.unionByName(near).join(ids.withColumnRenamed("t_id", "told"), "t_no").select("no", "told")
    with_title = every.filter("hidden is not null").withColumn("t_no", F.col("hidden")).join(t.drop("rarest", "phase"), "t_no").join(told, "no", "left")
    named_at_all = F.size("t_common") + F.size("t_rare") > 0
    same = named_at_all & (F.size(F.array_except("t_common", "common")) == 0) & (F.size(F.array_except("t_rare", "words")) == 0)
    fits = F.coalesce(_head_agrees(), F.lit(True))
    near_same = (F.size("t_common") > 0) & fits & (_shared() >= 0.5)
    # the title names another target, or shares neither rare words nor half of the common ones
    against = F.coalesce(F.col("told") != F.col("t_id"), F.lit(False)) | ((F.size("common") > 0) & ~fits & (_shared() < 0.5))
    kind = F.when(same, "number_and_title").when(near_same, "number_and_near_title").otherwise("number")
    with_title = cut(with_title.select("no", "t_no", "t_id", "told", kind.alias("rule"), against.alias("against")))
    free = every.filter("hidden is null").select("no")
    weak = title.withColumn("rule", F.lit("title")).unionByName(near.withColumn("rule", F.lit("near_title"))).join(free, "no", "left_semi")
    odd = digits.filter("agrees is null or agrees").select("no", "t_no", F.lit("near_number").alias("rule"))
    found = reduce(DataFrame.unionByName, [with_title.filter("not against").select("no", "t_no", "rule"), weak, odd]).join(ids, "t_no")
    found = join_counted(held, titles.select("no", "title", "n").join(found, "no"), "title", "n").select("record_id", F.col("t_id").alias("target_id"), "rule")

    if labels is not None:
        true = labels.select("record_id", F.col("target_id").alias("true_id")).distinct()
        each = found.join(true, "record_id").groupBy("rule", "record_id").agg(F.max((F.col("target_id") == F.col("true_id")).cast("int")).alias("hit"))
        tally = each.groupBy("rule").agg(F.sum("hit").alias("hits"), F.count("*").alias("judged"))
        sure = {x.rule: (x.hits + prior_hits) / (x.judged + prior_hits + prior_misses) for x in tally.collect()}
    else:
        hit = lambda df, rule, ok, held_out: df.filter(held_out).select(F.lit(rule).alias("rule"), ok.cast("int").alias("hit"))
        owner = with_title.select("no", F.col("t_id").alias("true_id"))
        judged = lambda df, rule: df.join(ids, "t_no").join(owner, "no").select(F.lit(rule).alias("rule"), (F.col("t_id") == F.col("true_id")).cast("int").alias("hit"))
        each = [
            judged(title, "title"), judged(near, "near_title"),
            hit(with_title, "number", F.col("t_id") == F.col("told"), F.col("told").isNotNull()), hit(digits, "near_number", F.col("agrees"), F.col("agrees").isNotNull()),
        ]
        tally = reduce(DataFrame.unionByName, each).groupBy("rule").agg(F.sum("hit").alias("hits"), F.count("*").alias("judged")).collect()
        sure = {x.rule: (x.hits + prior_hits) / (x.judged + prior_hits + prior_misses) for x in tally}
        prior = prior_hits / (prior_hits + prior_misses)
        p = lambda rule: sure.get(rule, prior)
        sure |= {"number_and_title": 1 - (1 - p("number")) * (1 - p("title")), "number_and_near_title": 1 - (1 - p("number")) * (1 - p("near_title"))}
    prior = prior_hits / (prior_hits + prior_misses)
    score = spark.createDataFrame([(rule, round(sure.get(rule, prior), 6)) for rule in RULES], "rule string, confidence double")
    return found.join(F.broadcast(score), "rule").filter(F.col("confidence") >= least).select("record_id", "target_id", "rule", "confidence")


RULES = ("number_and_title", "number_and_near_title", "number", "title", "near_title", "near_number")


def project_titles(projects: DataFrame) -> DataFrame:
    """Targets of dl_silver_projects; a name that only repeats the row's own id is none."""
    own = F.contains(F.coalesce("project_name", F.lit("")), F.trim("project_id"))
    return projects.filter(F.col("project_id").isNotNull()).select(F.trim("project_id").alias("target_id"), F.when(~own, F.col("project_name")).alias("title"), F.col("project_number").alias("number"))


def job_titles(customers: DataFrame) -> DataFrame:
    """Records of dl_silver_qbo_customers: the job rows right below a client; its sub-jobs, the
    client rows and rows without an id are left out. The title is the last part of the fully
    qualified name, or the display name where that is missing."""
    path = F.split(F.coalesce("fully_qualified_name", F.lit("")), ":")
    leaf = F.when(F.size(path) >= 2, F.element_at(path, -1)).otherwise(F.coalesce("display_name", "fully_qualified_name"))
    jobs = customers.filter(F.col("qbo_customer_id").isNotNull() & (F.coalesce("is_job", F.lit(False)) | F.coalesce("is_project", F.lit(False))))
    return jobs.filter(F.size(path) <= 2).select(F.trim("qbo_customer_id").alias("record_id"), leaf.alias("title"))


def match_projects_to_jobs(projects: DataFrame, customers: DataFrame, labels: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """(project_id, qbo_customer_id, rule, confidence); several landings of a job may speak for one pair, the
    surest rule is kept."""
    found = match_entities(job_titles(customers), project_titles(projects), labels, least)
    return (
        found.groupBy(F.col("target_id").alias("project_id"), F.col("record_id").alias("qbo_customer_id"))
        .agg(F.max(F.struct("confidence", "rule")).alias("best"))
        .select("project_id", "qbo_customer_id", "best.rule", "best.confidence")
    )
