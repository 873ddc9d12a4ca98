r"""License scans by diagonal voting, in DataFrame operations only.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Templates are short phrases (the base) and notices of any length: the fixed
ones of this module, or a caller's table of whole notices or licenses. All
rolling word k-gram hashes of all documents (k = 2 for phrases, 3 for notices)
join the template positions that have the same hash. A match votes for the
diagonal (word position - template position); votes of a document, template
and diagonal meet as bit masks, one for each BLOCK positions, so repeated rows
and repeated matches add nothing. A phrase stands wherever a diagonal has all
its grams. For notices, neighbouring diagonals (up to ``neighbours`` words put
in or left out at a place), however few their votes, merge into one chain;
LEAST_VOTES holds for the chain. A chain is verified if some MOST_STRETCH times
the notice's length in words holds LEAST_COVER of its grams, found by one sweep
over the chain's matches. In a notice so short that one word put in takes more
grams than that, it is also enough that such a stretch holds all words of the
notice: in matched grams, or as its first or last two words beside them.

The fixed templates are a few hundred positions and are broadcast. A caller's
table is written and counted; it is broadcast up to BROADCAST_POSITIONS
(some 20 MB), beyond that Spark joins by gram. Matches alone are shuffled, keyed
by document, text and template, and written to the shared folder; nothing is
gathered into one row, and a chain is swept in sorted order.

Cases: null and empty texts have no words, no labels and score 0; repeated
rows each get the same row; null ids are kept; an empty table gives an empty
result; other columns are not read. Notices with a null text or label, or of
fewer words than NOTICE_GRAM, match nothing; repeated ones count once; no
notices leave the base. Words are compared by the 64-bit hash of their k-gram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulwise.llm.store import materialize

PHRASE_GRAM, NOTICE_GRAM = 2, 3
LEAST_COVER = 0.8
MOST_STRETCH = 1.3
#: Diagonals this far apart merge; in long notices those a SHIFT-th of the notice apart do.
NEIGHBOURS, SHIFT = 4, 16
#: Votes below which a notice's merged chain is noise.
LEAST_VOTES = 3
#: Template positions of one bit mask.
BLOCK = 62
#: Positions of a caller's templates up to which they are broadcast (rows of some 60 bytes).
BROADCAST_POSITIONS = 300_000

# Phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
# Characteristic sentences of notices and their labels.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

#: Runs that separate words; A-Z are inside words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The one non-ASCII character that lower-cases to an ASCII letter, and a letter that has no other case.
KELVIN, KEPT = "\u212a", "\u0138"


def _rolled(words: F.Column) -> tuple[F.Column, F.Column]:
    """Hashes of the 2 and of the 3 words from each position (fewer at the end, which match no template)."""
    rest = lambda n: F.slice(words, F.lit(n), F.greatest(F.size(words), F.lit(1)))
    two = F.zip_with(words, rest(2), lambda a, b: F.xxhash64(a, b))
    return two, F.zip_with(two, rest(3), lambda a, b: F.xxhash64(a, b))


def templates(spark: SparkSession, notices: DataFrame | None = None, text_col: str = "text",
              label_col: str = "label") -> DataFrame:
    """One row per template position: template, label, base, n (grams), size (words), at, gram, and pair (2 words).

    ``notices`` has a text and a label a row and takes the place of NOTICES.
    """
    fixed = [F.struct(F.lit(label).alias("label"), F.lit(base).alias("base"), F.split(F.lit(text), " ").alias("words"))
             for text, label, base in [(*p, True) for p in PHRASES]
             + [(*n, False) for n in NOTICES if notices is None]]
    table = spark.range(1).select(F.inline(F.array(*fixed)))
    if notices is not None:
        own = notices.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
            F.col(label_col).cast("string").alias("label"), F.lit(False).alias("base"),
            words_of(F.col(text_col)).alias("words"))
        table = table.union(own.where(F.size("words") >= NOTICE_GRAM).distinct())
    k = F.when(F.col("base"), PHRASE_GRAM).otherwise(NOTICE_GRAM)
    two, three = _rolled(F.col("words"))
    size = F.size("words")
    sized = table.select(F.xxhash64("label", "base", "words").alias("template"), "label", "base",
                         (size - k + 1).alias("n"), size.alias("size"), two.alias("two"), three.alias("three"))
    kept = ["template", "label", "base", "n", "size"]
    hashes = F.when(F.col("base"), F.col("two")).otherwise(F.col("three"))
    grams = sized.select(*kept, F.posexplode(F.slice(hashes, F.lit(1), F.col("n"))).alias("at", "gram"),
                         F.col("base").alias("pair"))
    ends = sized.where(~F.col("base") & _short()).select(
        *kept, F.posexplode(F.slice("two", F.lit(1), F.col("size") - 1)).alias("at", "gram"), F.lit(True).alias("pair"))
    return grams.union(ends.where((F.col("at") == 0) | (F.col("at") == F.col("size") - 2)))


def _short() -> F.Column:
    """Whether one word put into the notice takes more grams than LEAST_COVER allows (so it fits one mask)."""
    return (F.col("n") - (NOTICE_GRAM - 1)) / F.col("n") < LEAST_COVER


def neighbours() -> F.Column:
    """Distance up to which two diagonals of a notice merge."""
    return F.greatest(F.lit(NEIGHBOURS), F.floor(F.col("size") / SHIFT))


def words_of(text: F.Column) -> F.Column:
    """Words of a text, lower-cased; null has none."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(KEPT)))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def votes(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """Diagonals: id, text_hash, template columns, diagonal, block, mask (positions met of the block's), ends (those of
    a short notice's first and last two words)."""
    rolled = docs.select("id", "text_hash", F.size("words").alias("n_words"),
                         F.concat(*_rolled(F.col("words"))).alias("grams"))
    # outer: the plain form adds a filter that works the hashes out a second time
    placed = rolled.select("id", "text_hash", "n_words", F.posexplode_outer("grams").alias("slot", "gram"))
    found = placed.join(positions, "gram")
    place = F.when(F.col("pair"), F.col("slot")).otherwise(F.col("slot") - F.col("n_words"))
    found = found.withColumn("place", place).where(
        F.col("pair") == (F.col("slot") < F.col("n_words")))  # two words meet 2-grams only
    end = F.col("pair") & ~F.col("base")
    bit = F.expr(f"shiftleft(1L, at % {BLOCK})")
    return found.groupBy("id", "text_hash", "template", "label", "base", "n", "size",
                         (F.col("place") - F.col("at")).alias("diagonal"),
                         F.floor(F.col("at") / BLOCK).cast("int").alias("block")) \
        .agg(F.bit_or(F.when(end, 0).otherwise(bit)).alias("mask"), F.bit_or(F.when(end, bit).otherwise(0)).alias("ends"))


def _units(mask: F.Column, word: bool) -> F.Column:
    """Template positions of a mask's bits, as an array of (word, unit)."""
    is_set = lambda i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), is_set),
                       lambda i: F.struct(F.lit(word).alias("word"), (F.col("block") * BLOCK + i).alias("unit")))


def notice_spans(diagonals: DataFrame) -> DataFrame:
    """Chains of notices: id, text_hash, label, cover, low (first word of the fullest stretch), verified."""
    text = ["id", "text_hash", "template"]
    chain = [*text, "chain"]
    order = Window.partitionBy(*text).orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > neighbours()
    marked = diagonals.where(~F.col("base")).withColumn("new", F.coalesce(far, F.lit(True)).cast("int"))
    chained = marked.withColumn("chain", F.sum("new").over(order)) \
        .withColumn("votes", F.sum(F.bit_count("mask")).over(Window.partitionBy(*chain))).where(F.col("votes") >= LEAST_VOTES)
    words = F.expr("mask | shiftleft(mask, 1) | shiftleft(mask, 2) | ends | shiftleft(ends, 1)")
    none = F.lit(0).cast("long")
    units = chained.select(*chain, "label", "n", "size", "diagonal", F.inline(F.concat(
        _units(F.col("mask"), False), _units(F.when(_short(), words).otherwise(none), True))))
    same = Window.partitionBy(*chain, "word", "unit").orderBy("place")
    placed = units.withColumn("place", (F.col("diagonal") + F.col("unit")).cast("long")) \
        .withColumn("before", F.lag("place").over(same))
    # A unit counts once a stretch, where it stands first: for the stretches that start after its place before and
    # reach this one. The sweep goes from the right, so a count is reached at the place of a match.
    reach = F.floor(F.col("size") * MOST_STRETCH) - F.when(F.col("word"), 1).otherwise(NOTICE_GRAM)
    step = lambda start, by, new: F.struct(start.alias("start"), F.lit(by).alias("by"), new.alias("new"))
    events = placed.select(*chain, "label", "n", "size", "word", F.inline(F.array(
        step(F.col("place"), 1, F.col("before").isNull()),
        step(F.greatest(F.col("before"), F.col("place") - reach - 1), -1, F.lit(False)))))
    sweep = Window.partitionBy(*chain, "word").orderBy(F.desc("start"))
    swept = events.withColumn("held", F.sum("by").over(sweep))
    grams = ~F.col("word")
    found = swept.groupBy(*chain, "label", "n", "size").agg(
        F.max(F.when(grams, F.col("held"))).alias("grams"), F.max(F.when(~grams, F.col("held"))).alias("words"),
        F.count_if(grams & F.col("new")).alias("met"),
        F.max_by("start", F.when(grams, F.struct("held", -F.col("start")))).alias("low"))
    covered = F.col("grams") / F.col("n")
    verified = (covered >= LEAST_COVER) | (_short() & F.coalesce(F.col("words") == F.col("size"), F.lit(False)))
    return found.where(F.col("met") >= LEAST_VOTES).select(
        "id", "text_hash", "label", F.when(verified, covered).otherwise(F.col("met") / F.col("n")).alias("cover"),
        "low", verified.alias("verified"))


def _positions(documents: DataFrame, notices: DataFrame | None, text_col: str, label_col: str) -> DataFrame:
    """Template positions, marked for broadcast where their number is known to be small."""
    if notices is None:
        return F.broadcast(templates(documents.sparkSession))
    table = materialize(templates(documents.sparkSession, notices, text_col, label_col), "license-templates")
    return F.broadcast(table) if table.count() <= BROADCAST_POSITIONS else table


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: DataFrame | None = None,
         notice_col: str = "text", label_col: str = "label") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``notices`` (columns ``notice_col`` and ``label_col``) takes the place of the fixed notices.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                            words_of(F.col(text_col)).alias("words"))
    positions = _positions(documents, notices, notice_col, label_col)
    diagonals = materialize(votes(docs, positions), "license-diagonals")
    whole = F.expr("shiftleft(1L, n) - 1L")
    places = diagonals.where(F.col("base") & (F.col("mask") == whole)).select(
        "id", "text_hash", "label", F.lit(1.0).alias("cover"), F.col("diagonal").alias("low"),
        F.lit(True).alias("verified"), F.lit(True).alias("base"))
    notices = notice_spans(diagonals).select("id", "text_hash", "label", "cover", "low", "verified",
                                             F.lit(False).alias("base"))
    joined = lambda keep: F.array_join(F.sort_array(F.collect_set(F.when(keep, F.col("label")))), ",")
    start = F.when(F.col("base"), F.col("low"))
    found = places.union(notices).groupBy("id", "text_hash").agg(
        F.count_if("base").alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.col("verified")).alias("labels"),
        F.max(F.least(F.when(F.col("verified"), F.col("cover")).otherwise(F.col("cover") * 0.5), F.lit(1.0)))
        .alias("score"))
    sized = docs.select("id", "text_hash", F.size("words").cast("long").alias("n_words"))
    out = sized.alias("d").join(found.alias("f"), F.col("d.id").eqNullSafe(F.col("f.id"))
                                & (F.col("d.text_hash") == F.col("f.text_hash")), "left")
    return out.select(
        F.col("d.id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
