"""Extractive summaries: the best sentences of a text as bullets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.arrays import empty_strings
from curatrix.functions.text import contains_term
from curatrix.session import materialise, spread

# An end mark ends a sentence before white space, with the quotes that close it, and not
# after a single letter, so decimals and initials stay whole. The mark is found first; what
# stands before it is looked at only then.
_END = r"""([.!?](?<=(?:[A-Za-zÀ-ÿ]{2}|[^A-Za-zÀ-ÿ\s])[.!?])[.!?]*["')\]]*)[ \t]+"""
CUE_BOOST = 20_000_000

# Bounds of the table of word weights that every task holds.
HELD_WORDS = 1_000_000
HELD_BYTES = 64 << 20


def sentences(text: Column) -> Column:
    """The sentences of a text in order and trimmed; each line ends one, also without a mark."""
    lines = F.split(F.regexp_replace(text, F.lit(_END), F.lit("$1\n")), "\n")
    return F.filter(F.transform(lines, lambda s: F.trim(s)), lambda s: s != "")


def words(text: Column) -> Column:
    return F.split(F.lower(text), " ")


def boosted(base: Column, sentence: Column, cues: Sequence[str]) -> Column:
    """A score with a boost for each cue term in the sentence."""
    for cue in cues:
        boost = contains_term(F.lower(sentence), F.lower(F.lit(cue)))
        base = base + F.when(boost, F.lit(CUE_BOOST)).otherwise(F.lit(0))
    return base


def word_weights(texts: DataFrame, text: str) -> DataFrame:
    """Inverse document frequency of every word, in millionths, so sums do not depend on order."""
    n_texts = texts.agg(F.count(text)).first()[0]
    return (
        texts.filter(F.col(text).isNotNull())
        .select(F.explode(F.array_distinct(words(F.col(text)))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("word", "n", F.round(F.ln(F.lit(n_texts) / F.col("n")) * 1_000_000).cast("long").alias("weight"))
    )


def _step(n: Column) -> Column:
    """Quarters of an octave: numbers of texts that are held or not held together."""
    return F.floor(F.log2(n) * 4).cast("int")


def held_from(weights: DataFrame, max_rows: int, max_bytes: int) -> int:
    """The least step of which all words, with those of more texts, stay within the bounds."""
    sizes = (
        weights.groupBy(_step(F.col("n")).alias("step"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("word") + 32).alias("bytes"))
        .orderBy(F.desc("step"))
        .collect()  # four numbers for each doubling of a word's texts
    )
    n_rows = n_bytes = 0
    least = sizes[0]["step"] + 1 if sizes else 0
    for size in sizes:
        n_rows, n_bytes = n_rows + size["rows"], n_bytes + size["bytes"]
        if n_rows > max_rows or n_bytes > max_bytes:
            break
        least = size["step"]
    return least


def rarity_scores(numbered: DataFrame, text: str, cues: Sequence[str] = ()) -> DataFrame:
    """`_row`, `position` and `score`: summed weight of a sentence's words, repeats included, and boosts.

    The weights of the words that most texts have, as many as the bounds allow, travel to
    the texts and are added up there. Only the other words, each of few texts, are
    shuffled to meet their weights. All else that is shuffled are numbers.
    """
    weights = materialise(word_weights(numbered, text), "weights")
    least = held_from(weights, HELD_WORDS, HELD_BYTES)
    step = _step(F.col("n"))
    held = F.broadcast(weights.filter(step >= least).select("word", "weight"))
    found = numbered.select("_row", F.posexplode(sentences(F.col(text))).alias("position", "sentence"))
    # Two steps, so a sentence's cues are looked for once and not for each of its words.
    found = found.select(
        "_row", "position", boosted(F.lit(0).cast("long"), F.col("sentence"), cues).alias("boost"),
        words(F.col("sentence")).alias("words"),
    )
    used = found.select("_row", "position", "boost", F.explode("words").alias("word"))
    weighed = used.join(held, "word", "left").select("_row", "position", "boost", F.coalesce("weight", F.lit(0)).alias("weight"))
    if not weights.filter(step < least).isEmpty():
        # Every sentence has its row and its boost above.
        others = used.join(held, "word", "left_anti").select("_row", "position", "word")
        rare = others.join(weights.filter(step < least).select("word", "weight"), "word")
        weighed = weighed.unionByName(rare.select("_row", "position", F.lit(0).cast("long").alias("boost"), "weight"))
    return weighed.groupBy("_row", "position").agg((F.sum("weight") + F.max("boost")).alias("score"))


def _bullet(sentence: Column) -> Column:
    return F.concat(F.lit("•"), sentence)


def _ranked(scored: Column, k: int, by_position: bool) -> Column:
    """Positions of the `k` best of an array of `(minus_score, position)`."""
    best = F.transform(F.slice(F.sort_array(scored), 1, k), lambda s: s["position"])
    return F.sort_array(best) if by_position else best


def _diverse(scored: Column, k: int) -> Column:
    """Positions of `k` sentences by maximal marginal relevance, from `(score, position, words)`.

    One after another the sentence is taken that is worth most: its score less the share
    of its different words that the ones taken before have already. Words are compared
    by a 64-bit digest.
    """
    def worth(state: Column, s: Column) -> Column:
        n = F.greatest(F.size(s["words"]), F.lit(1))
        fresh = F.size(F.array_except(s["words"], state["words"]))
        # Whole numbers, so ties are ties; they go to the earlier sentence.
        return F.struct((-F.floor(s["score"] * fresh / n)).alias("minus"), s["position"].alias("position"), s["words"].alias("words"))

    def take(state: Column, _: Column) -> Column:
        left = F.filter(scored, lambda s: ~F.array_contains(state["taken"], s["position"]))
        best = F.array_min(F.transform(left, lambda s: worth(state, s)))
        return F.when(F.size(left) == 0, state).otherwise(
            F.struct(
                F.array_append(state["taken"], best["position"]).alias("taken"),
                F.array_union(state["words"], best["words"]).alias("words"),
            )
        )

    nothing = F.struct(F.array().cast("array<int>").alias("taken"), F.array().cast("array<bigint>").alias("words"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(k)), nothing, take, lambda state: state["taken"])


def summarise(
    articles: DataFrame,
    text: str,
    name: str = "summary",
    k: int = 3,
    score: str = "rarity",
    cues: Sequence[str] = (),
    by_position: bool = False,
    diverse: bool = False,
) -> DataFrame:
    """Add the `k` best sentences, best first or in text order; null without sentences.

    `score` is `rarity` (corpus weights of the words plus a boost for sentences with a cue
    term) or `length`. By length, sentences are ranked inside their own row and nothing
    is shuffled. With `diverse` a sentence counts for less the more of its words the
    sentences chosen before have, so that no point is made twice.
    """
    columns = [F.col(f"`{c}`") for c in articles.columns]
    if score == "rarity":
        numbered = materialise(spread(articles).withColumn("_row", F.monotonically_increasing_id()), "articles")
        entry = F.struct((-F.col("score")).alias("minus_score"), "position")
        # One text's sentences, as two numbers each.
        lists = rarity_scores(numbered, text, cues).groupBy(F.col("_row").alias("_of")).agg(F.collect_list(entry).alias("_list"))
        listed = numbered.join(lists, F.col("_row") == F.col("_of"), "left")
        scored = F.coalesce("_list", F.array().cast("array<struct<minus_score:bigint,position:int>>"))
        listed = listed.select(*columns, scored.alias("_scored"), sentences(F.col(text)).alias("_sentences"))
    elif score == "length":
        # Two steps, so sentences are found once although they are used several times.
        listed = spread(articles).select(*columns, F.coalesce(sentences(F.col(text)), empty_strings()).alias("_sentences"))
        length = F.transform(
            "_sentences",
            lambda s, i: F.struct((-boosted(F.length(s).cast("long"), s, cues)).alias("minus_score"), i.alias("position")),
        )
        listed = listed.select(*columns, length.alias("_scored"), "_sentences")
    else:
        raise ValueError(f"unknown score {score!r}")
    if diverse:
        with_words = F.transform(
            "_scored",
            lambda s: F.struct(
                (-s["minus_score"]).alias("score"),
                s["position"].alias("position"),
                F.array_distinct(
                    F.transform(words(F.get("_sentences", s["position"])), lambda w: F.xxhash64(w))
                ).alias("words"),
            ),
        )
        listed = listed.withColumn("_scored", with_words)
        chosen = _diverse(F.col("_scored"), k)
        chosen = F.sort_array(chosen) if by_position else chosen
    else:
        chosen = _ranked(F.col("_scored"), k, by_position)
    lines = F.transform(chosen, lambda p: _bullet(F.get("_sentences", p)))
    listed = listed.select(*columns, lines.alias("_lines"))
    return listed.select(*columns, F.when(F.size("_lines") > 0, F.array_join("_lines", "\n")).alias(name))
