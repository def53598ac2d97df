"""Matching labels to a master, cheapest test first, always inside a block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text
from ..functions.similarity import token_sort_ratio
from ..rules import first_by
from ..sources.stages import dealt, merged, staged
from .likeness import MANY, alike_pairs, best_alike, structure


def structure_conflict(a: Column, b: Column) -> Column:
    """Different years named, or only one of them a fund of funds, or (of others) an exchange-traded fund."""
    return _apart(*structure(a), *structure(b))


def _apart(kind_a: Column, years_a: Column, kind_b: Column, years_b: Column) -> Column:
    apart = (years_a != "") & (years_b != "") & ~F.arrays_overlap(F.split(years_a, ","), F.split(years_b, ","))
    return apart | (kind_a != kind_b)


def containment_score(label: Column, name: Column) -> Column:
    """100 for equal keys; 90 to 99 where one contains the other; else 0. Both are compact keys."""
    extra = F.abs(F.length(name) - F.length(label))
    inside = F.greatest(F.lit(90.0), 99 - F.least(extra, F.lit(20)) * 0.3)
    around = F.greatest(F.lit(90.0), 99 - F.least(extra, F.lit(40)) * 0.2)
    return F.when(label == name, 100.0).when((F.length(label) > 0) & F.contains(name, label), inside).when((F.length(name) >= 10) & F.contains(label, name), around).otherwise(0.0)


_GRAMS = (8, 4, 1)
FEW_BLOCKS = 10_000  # so many blocks, counted, may be broadcast


def _pieces(key: str, size) -> Column:
    """All stretches of ``size`` characters of a key (it has as many)."""
    return F.transform(F.sequence(F.lit(1), F.length(key) - size + 1), lambda i: F.substring(F.col(key), i, size))


def _longest(key: str) -> Column:
    """The longest size of stretches that a key has."""
    return F.coalesce(*[F.when(F.length(key) >= g, F.lit(g)) for g in _GRAMS])


def _one_piece(df: DataFrame, key: str, id_: str, block: str, others: DataFrame) -> DataFrame:
    """A stretch that stands for the key: of its longest size, the one that fewest of the others hold. A key with a stretch that none holds has no partner."""
    own = df.where(F.length(key) > 0).withColumn("__g", F.explode(F.array_distinct(_pieces(key, _longest(key)))))
    often = others.groupBy(block, "__g").agg(F.count("*").alias("__f"))
    own = own.join(merged(often), [block, "__g"], "left").withColumn("__f", F.coalesce("__f", F.lit(0)))
    rare = own.groupBy(id_, block, key).agg(F.min(F.struct("__f", F.xxhash64("__g"), "__g")).alias("__x"))
    return rare.where(F.col("__x.__f") > 0).select(id_, block, key, F.col("__x.__g").alias("__g"))


def _every_piece(df: DataFrame, key: str, sizes: tuple[int, ...] = _GRAMS) -> DataFrame:
    none = F.array().cast("array<string>")
    return df.withColumn("__g", F.explode(F.array_distinct(F.flatten(F.array(none, *[F.when(F.length(key) >= g, _pieces(key, g)).otherwise(none) for g in sizes])))))


def _sizes(df: DataFrame, key: str) -> tuple[int, ...]:
    """The sizes of stretches that stand for some of the keys: three at most."""
    return tuple(r[0] for r in df.where(F.length(key) > 0).select(_longest(key)).distinct().collect())


def holding_pairs(a: DataFrame, b: DataFrame, block: str, least: int = 10) -> DataFrame:
    """(label_id, code) of a block's compact keys ``__a`` and ``__b`` of which one may hold the other; ``__b`` is held from ``least`` characters on.

    Blocks of at most ``MANY`` pairs meet whole: all their stretches would be more rows than their pairs. In larger ones
    a key that is held has all its stretches in the one that holds it, so the rarest of them, joined by equality, finds
    all such pairs; work grows with the keys, not with the block's square, and no common stretch is a hot key.
    """
    a, b = a.select("label_id", block, "__a"), b.select("code", block, "__b")
    sizes = a.groupBy(block).agg(F.count("*").alias("n_a")).join(merged(b.groupBy(block).agg(F.count("*").alias("n_b"))), block)
    sizes = staged(sizes.select(block, (F.col("n_a") * F.col("n_b") <= MANY).alias("small")))
    n = dict(map(tuple, sizes.groupBy("small").count().collect()))  # two rows at most
    small, large = [d if n.get(k, 0) <= FEW_BLOCKS else merged(d) for k, d in ((True, sizes.where("small").select(block)), (False, sizes.where("not small").select(block)))]
    inside = (F.length("__a") > 0) & F.contains("__b", F.col("__a"))
    around = (F.length("__b") >= max(least, 1)) & F.contains("__a", F.col("__b"))
    met = a.join(small, block).join(merged(b), block).where(inside | around).select("label_id", "code", block)
    if n.get(False):
        met = met.unionByName(_by_stretches(a.join(large, block, "left_semi"), b.join(large, block, "left_semi"), block, least))
    return met.distinct()


def _by_stretches(a: DataFrame, b: DataFrame, block: str, least: int) -> DataFrame:
    """The pairs of ``holding_pairs``, once or twice each, by joins on the rarest stretch of a key."""
    long = b.where(F.length("__b") >= least)
    all_b, all_a = _every_piece(b, "__b", _sizes(a, "__a")), _every_piece(a, "__a", _sizes(long, "__b"))
    inside = _one_piece(a, "__a", "label_id", block, all_b).join(merged(all_b), [block, "__g"])
    around = all_a.join(merged(_one_piece(long, "__b", "code", block, all_a)), [block, "__g"])
    both = inside.where(F.contains("__b", F.col("__a"))).unionByName(around.where(F.contains("__a", F.col("__b"))))
    return both.select("label_id", "code", block)


def contained(labels: DataFrame, master: DataFrame, block: str, cutoff: float = 90.0) -> DataFrame:
    """The best containment match of each label in its block: score, then the longer key, then the key.

    Labels of one key, and names of one key, that agree in structure meet once, however many there are.
    """
    kind_a, years_a = structure(F.col("label"))
    kind_b, years_b = structure(F.col("name"))
    a = labels.select("*", text.compact(F.col("label")).alias("__a"), kind_a.alias("__ka"), years_a.alias("__ya"))
    b = master.select("code", block, "name", text.compact(F.col("name")).alias("__b"), kind_b.alias("__kb"), years_b.alias("__yb"))
    own = [block, "__a", "__ka", "__ya"]
    lefts = dealt(a.select(*own).distinct())
    rights = dealt(b.groupBy(block, "__b", "__kb", "__yb").agg(F.min(F.struct("code", "name")).alias("__m")))
    met = holding_pairs(lefts.select(F.col("__a").alias("label_id"), block, "__a").distinct(), rights.select(F.col("__b").alias("code"), block, "__b").distinct(), block)
    met = staged(met.select(F.col("label_id").alias("__a"), F.col("code").alias("__b"), block))
    pairs = met.join(merged(lefts), [block, "__a"]).join(merged(rights), [block, "__b"]).withColumn("score", containment_score(F.col("__a"), F.col("__b")))
    pairs = pairs.where((F.col("score") >= cutoff) & ~_apart(*map(F.col, ("__ka", "__ya", "__kb", "__yb"))))
    best = pairs.groupBy(*own).agg(F.min(F.struct((-F.col("score")).alias("down"), (-F.length("__b")).alias("shorter"), "__b", F.col("__m.code").alias("code"), F.col("__m.name").alias("name"))).alias("__x"))
    found = a.join(merged(best), own).withColumns({"code": F.col("__x.code"), "name": F.col("__x.name"), "score": -F.col("__x.down")})
    return first_by(found, ["label_id"], [F.col("score").desc(), F.col("__x.shorter"), F.col("__x.__b"), F.col("code")]).drop("__a", "__ka", "__ya", "__x")


def fuzzy(labels: DataFrame, master: DataFrame, block: str, cutoff: float = 84.0) -> DataFrame:
    """label_id, code, score: the likeliest master name of each label in its block, for what is left after cheaper tests."""
    left = labels.select(F.col("label_id").alias("id"), block, F.col("label").alias("name"))
    right = master.select(F.col("code").alias("id"), block, "name")
    return best_alike(left, right, block, cutoff).select(F.col("id").alias("label_id"), F.col("other").alias("code"), "score")


def cascade(labels: DataFrame, master: DataFrame, shortcodes: DataFrame, block: str) -> DataFrame:
    """label_id, code, score, via: short code (exact, then any case), containment, likeness; shared keys bind the other funds of the same key.

    labels: label_id, block, label, shortcode. master: code, block, name. shortcodes: block, key, code.
    """
    bound, funds, held = _bound(labels, master, shortcodes, block)
    shared = funds.join(merged(held), [block, "k"]).select("label_id", "code", F.lit(100.0).alias("score"), F.lit("key_share").alias("via"))
    return bound.unionByName(shared)


def via_counts(labels: DataFrame, master: DataFrame, shortcodes: DataFrame, block: str) -> DataFrame:
    """via, n: how many rows of ``cascade`` each way gives; rows of shared keys are counted key by key, not written out."""
    bound, funds, held = _bound(labels, master, shortcodes, block)
    each = funds.groupBy(block, "k").agg(F.count("*").alias("a")).join(merged(held.groupBy(block, "k").agg(F.count("*").alias("b"))), [block, "k"])
    shared = each.agg(F.sum(F.col("a") * F.col("b")).alias("n")).select(F.lit("key_share").alias("via"), "n").where("n > 0")
    return bound.groupBy("via").agg(F.count("*").alias("n")).unionByName(shared)


def _bound(labels: DataFrame, master: DataFrame, shortcodes: DataFrame, block: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(label_id, code, score, via of all steps but shared keys; the funds that these leave unbound; the labels bound by key), each step staged."""
    exact = labels.join(merged(shortcodes.withColumnRenamed("key", "shortcode")), [block, "shortcode"]).select("label_id", "code", F.lit(0).alias("rank"))
    folded = labels.withColumn("k", F.lower("shortcode")).join(merged(shortcodes.select(block, F.lower("key").alias("k"), "code")), [block, "k"]).select("label_id", "code", F.lit(1).alias("rank"))
    short = staged(first_by(exact.unionByName(folded), ["label_id"], [F.col("rank"), F.col("code")]).select("label_id", "code", F.lit(100.0).alias("score"), F.lit("shortcode").alias("via")))
    left = staged(labels.join(merged(short), "label_id", "left_anti"))
    direct = staged(contained(left, master, block).select("label_id", "code", "score", F.lit("direct").alias("via")))
    rest = staged(left.join(merged(direct), "label_id", "left_anti"))
    likely = staged(fuzzy(rest, master, block).select("label_id", "code", "score", F.lit("fuzzy").alias("via")))
    bound = short.unionByName(direct).unionByName(likely)
    # funds with the compact key of a bound fund share its label
    keyed = staged(master.select("code", block, text.compact(text.base_name(F.col("name"))).alias("k")))
    held = staged(bound.join(merged(keyed), "code").select("label_id", block, "k"))
    funds = staged(keyed.join(merged(bound.select("code").distinct()), "code", "left_anti"))
    return bound, funds, held


def unmatched(master: DataFrame, matches: DataFrame) -> DataFrame:
    return master.join(matches.select("code"), "code", "left_anti")


def new_parents(parents: DataFrame, known: DataFrame, labels: DataFrame, mapped: DataFrame, block: str) -> DataFrame:
    """Parents not known yet with their best label (2 points less for labels mapped already) and what to do: bind from 95, review from 90, else add."""
    fresh = parents.join(known.select("code"), "code", "left_anti")
    less = labels.join(mapped.select("label_id", F.lit(2.0).alias("less")).distinct(), "label_id", "left").na.fill(0.0, ["less"])
    left = fresh.select(F.col("code").alias("id"), block, "name")
    right = less.select(F.col("label_id").alias("id"), block, F.col("label").alias("name"), "less")
    best = best_alike(left, right, block, -100.0, strict=False, longest=False)
    out = fresh.join(best.select(F.col("id").alias("code"), F.col("other").alias("label_id"), "score"), "code", "left")
    return out.withColumn("action", F.when(F.col("score") >= 95, "bind").when(F.col("score") >= 90, "review").otherwise("add"))


def house_core(c: Column) -> Column:
    """A fund house's name without the words that all of them share."""
    return text.squeeze(F.regexp_replace(text.norm_text(c), r"\b(mutual\s+fund|asset\s+management(?:\s+company)?|limited|ltd|pvt|private|company|amc|idf)\b", " "))


def map_houses(registry: DataFrame, official: DataFrame, cutoff: float = 86.0) -> DataFrame:
    """amc_id, official name, score of every registered house: the first of its three names whose core is an official one's, else the likeliest official core of all.

    registry: amc_id, name, amc_name. official: name.
    """
    cands = F.array(F.col("name"), F.col("amc_name"), F.replace(F.col("amc_id"), F.lit("-"), F.lit(" ")))
    a = registry.select("amc_id", F.posexplode(cands).alias("pos", "said")).withColumn("core", house_core(F.col("said"))).where("core <> ''")
    b = official.select(F.col("name").alias("official"), house_core(F.col("name")).alias("key")).where("key <> ''")
    b = first_by(b, ["key"], [F.col("official").desc()])
    exact = first_by(a.join(b, F.col("core") == F.col("key")), ["amc_id"], [F.col("pos")]).select("amc_id", "official", F.lit(100.0).alias("score"))
    rest = a.join(exact, "amc_id", "left_anti")
    word = lambda d, c: d.withColumn("__w", F.explode(F.array_distinct(F.transform(F.split(c, " "), lambda w: F.substring(w, 1, 2)))))
    # likeness of 86 or more shares the start of a word
    pairs = word(rest, "core").join(word(b, "key"), "__w").select("amc_id", "pos", "core", "official", "key").distinct()
    near = first_by(pairs.withColumn("score", token_sort_ratio("core", "key")), ["amc_id"], [F.col("score").desc(), F.col("pos"), F.col("official")])
    near = near.where(F.col("score") >= cutoff).select("amc_id", "official", "score")
    return registry.select("amc_id").join(exact.unionByName(near), "amc_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def _soft(key: Column) -> Column:
    """A compact key without a closing "fund"."""
    return F.regexp_replace(key, "fund$", "")


def _spread(df: DataFrame) -> DataFrame:
    """A small file's rows, dealt to all cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _length_ratio(a: str, b: str) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def _alike_keys(lack: DataFrame, have: DataFrame, block: str) -> DataFrame:
    """(code, sibling, score) of names whose sorted words are 94 and more alike, with keys of nearly one length; of equal names on the right the least sibling."""
    have = staged(have.where("words <> ''").groupBy(block, "words", "key").agg(F.min("code").alias("sibling")).withColumn("other", F.concat_ws("\n", block, "words")))
    own = staged(lack.where("words <> ''").select(block, "words", "key").distinct().withColumn("id", F.concat_ws("\n", block, "words")))
    left, right = own.select("id", block, F.col("words").alias("name")).distinct(), have.select(F.col("other").alias("id"), block, F.col("words").alias("name")).distinct()
    near = staged(alike_pairs(left, right, block, 94.0))
    pairs = near.join(own, "id").join(have.select("other", F.col("key").alias("kb"), "sibling"), "other").where(_length_ratio("key", "kb") >= 0.92)
    return lack.join(pairs.select(block, "words", "key", "sibling", "score"), [block, "words", "key"]).select("code", "sibling", "score")


def near_copies(master: DataFrame, bound: DataFrame, block: str) -> DataFrame:
    """code, sibling of unbound funds that are near-duplicates of bound ones: equal compact keys, equal but for a closing "fund", one inside the other (95), or likeness of 94 with lengths within 8 %. Ties: that order, then the least sibling.

    master: code, block, name. bound: code.
    """
    keyed = staged(_spread(master).select("code", block, text.norm_text(F.col("name")).alias("words"), names.root_key(F.col("name")).alias("key")).where("key <> ''"))
    codes = bound.select("code").distinct()
    have, lack = dealt(keyed.join(codes, "code", "left_semi")), dealt(keyed.join(codes, "code", "left_anti"))
    other = have.groupBy(block, F.col("key").alias("kb")).agg(F.min("code").alias("sibling"))  # the least sibling of a key is the one that counts
    soft_of = other.groupBy(block, _soft(F.col("kb")).alias("s")).agg(F.min("sibling").alias("sibling"))
    equal = lack.join(other.withColumnRenamed("kb", "key"), [block, "key"]).select("code", "sibling", F.lit(0).alias("rank"))
    soft = lack.withColumn("s", _soft(F.col("key"))).join(soft_of, [block, "s"]).select("code", "sibling", F.lit(1).alias("rank"))
    sure = staged(equal.unionByName(soft))
    rest = dealt(lack.join(sure, "code", "left_anti"))
    left, right = rest.select(F.col("key").alias("label_id"), block, F.col("key").alias("__a")).distinct(), other.select(F.col("kb").alias("code"), block, F.col("kb").alias("__b"))
    inside = holding_pairs(left, right, block, 1).select(F.col("label_id").alias("ka"), F.col("code").alias("kb"), block)
    inside = staged(inside.where((containment_score(F.col("ka"), F.col("kb")) >= 95) | (containment_score(F.col("kb"), F.col("ka")) >= 95)))
    held = inside.join(other, [block, "kb"]).groupBy(block, F.col("ka").alias("key")).agg(F.min("sibling").alias("sibling"))
    held = staged(rest.join(held, [block, "key"]).select("code", "sibling", F.lit(2).alias("rank")))
    alike = _alike_keys(rest.join(held, "code", "left_anti"), have, block).select("code", "sibling", F.lit(3).alias("rank"))
    return first_by(sure.unionByName(held).unionByName(alike), ["code"], [F.col("rank"), F.col("sibling")]).select("code", "sibling", F.lit(95.0).alias("score"), F.lit("compact").alias("via"))


def attach_variants(master: DataFrame, bound: DataFrame, block: str) -> DataFrame:
    """code, sibling, score of unbound variants: "invested in" a bound fund, or a bound fund's name once variant tails are gone, else that at a likeness of 95. Closed-end funds stay alone.

    master: code, block, name. bound: code.
    """
    m = _spread(master).where(~names.is_closed_end(F.col("name")))
    stripped = names.strip_variant(F.col("name"))
    keyed = staged(m.select("code", block, names.root_key(F.col("name")).alias("whole"), names.root_key(stripped).alias("key"), text.norm_text(stripped).alias("words"), names.root_key(text.invested_in(F.col("name"))).alias("host")))
    codes = bound.select("code").distinct()
    have, lack = dealt(keyed.join(codes, "code", "left_semi")), dealt(keyed.join(codes, "code", "left_anti"))
    # the least sibling of a key is the one that counts
    target = lambda k, *forms: have.select("code", block, F.explode(F.array_distinct(F.array(*forms))).alias(k)).groupBy(block, k).agg(F.min("code").alias("sibling"))
    whole, key = F.col("whole"), F.col("key")
    host = lack.where("host <> ''").join(target("host", whole), [block, "host"]).select("code", "sibling", F.lit(0).alias("rank"), F.lit(100.0).alias("score"))
    same = lack.where("key <> ''").join(target("key", key, whole), [block, "key"]).select("code", "sibling", F.lit(1).alias("rank"), F.lit(100.0).alias("score"))
    soft = lack.withColumn("s", _soft(key)).where("s <> ''").join(target("s", _soft(whole), _soft(key)), [block, "s"]).select("code", "sibling", F.lit(2).alias("rank"), F.lit(100.0).alias("score"))
    sure = staged(host.unionByName(same).unionByName(soft))
    alike = _alike_keys(lack.join(sure, "code", "left_anti"), have, block).where("score >= 95").select("code", "sibling", F.lit(3).alias("rank"), "score")
    return first_by(sure.unionByName(alike), ["code"], [F.col("rank"), F.col("score").desc(), F.col("sibling")]).select("code", "sibling", "score", F.lit("sibling").alias("via"))


def full_cascade(labels: DataFrame, master: DataFrame, shortcodes: DataFrame, block: str) -> DataFrame:
    """``cascade``, then near copies and variants of the funds that are bound: (code, via, sibling) of every bound fund."""
    direct, funds, held = _bound(labels, master, shortcodes, block)
    shared = funds.join(held.select(block, "k").distinct(), [block, "k"], "left_semi").select("code", F.lit("key_share").alias("via"))
    every = direct.select("code", "via").unionByName(shared).groupBy("code").agg(F.min("via").alias("via"))
    bound = staged(every.withColumn("sibling", F.lit(None).cast(master.schema["code"].dataType)))
    copies = near_copies(master, bound, block).select("code", "via", "sibling")
    bound = staged(bound.unionByName(copies))
    return bound.unionByName(attach_variants(master, bound, block).select("code", "via", "sibling"))
