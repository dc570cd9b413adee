"""Licence notices in documents, by a trained paragraph classifier.

All of it is DataFrame code on built-in functions.

1. A paragraph is a line; its words are runs of a-z, 0-9 and +, lower-cased.
   Features are the words and word pairs of the notices below, present or not.
2. A multinomial logistic regression with an L1 part, so most weights are zero, is
   fitted to these notices, to a few sentences that only sound like them, and to
   lines of at most ``sample_docs`` documents, chosen by hash, as class ``unknown``.
   Lines that hold half of a notice, or a pair of two of its telling words, may be
   notices and are not taken for unknown.
3. The unknown class is calibrated on the lines of all documents, each distinct line
   once and the same ones left out: its bias is raised until no more than
   ``false_alarms`` of them are named a family.
4. A named family is confirmed where the line holds at least ``share`` of the word
   pairs of one of its notices, counting pairs with a telling word.

5. A notice may be wrapped.  From every line on, as many lines without a blank one
   between them are joined as any notice can need, comment marks left out.  Where
   the joined lines hold ``share`` of a notice and none of them does by itself, its
   family is confirmed for them, at the last line from which most of it is held.  A
   family whose pairs found are all part of another's is not reported beside it.
   Of a notice repeated without a blank line between, the last place is reported.

A line without any telling word can neither be named nor confirmed, so those are
left out before their features are built.  What holds a share of a notice holds at
least one of its key pairs, so texts and lines without any are left out before they
are compared with all notices.  Both are told by one search of the text, without
splitting it into words.  Whole texts of all documents are read.

Null and empty texts have no paragraphs.  Repeated rows are reported alike, once
for each row; a null id stays null.  An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodmark.llm.common import read, written

SAMPLE_DOCS = 400
FALSE_ALARMS = 0.001
SHARE = 0.6
UNKNOWN = "unknown"

# Usual short notices of licence families; fixed values.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "This file is licensed under the Apache License Version 2.0 (the License)"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("gpl", "Released under the GPL version 2 or any later version"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "Released under the LGPL version 3"),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "Released under the AGPL version 3"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("reserved", "All rights reserved."),
    ("reserved", "Copyright, all rights reserved. No part may be reproduced without written permission."),
]
# Sentences that hold some of the words but are no notices; fixed values.
OTHERS = [
    "He renewed his driving license at the public office in May.",
    "The right of way is reserved for buses and all taxis.",
    "This version of the work was released in the spring.",
    "She used the general terms of the file without permission.",
    "Free software is a matter of copy and purpose.",
    "All seats were reserved and the rights of guests were respected.",
    "The source of the river is under the mountain.",
    "A person may use the form to obtain a copy of the law.",
    "The public was granted access free of charge.",
    "Students at MIT released a new program.",
]
# Words that tell nothing by themselves; fixed values.
PLAIN = "a all any are by can for forms has in into is it may no not of or part person possible possession the this to under use v with without you be and at an on as".split()


# Comment marks that are words; others are no part of words anyway.
MARK = r"^\s*(?:dnl|rem|REM)(?=\s|$)"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9+]+"), lambda w: w != "")


def pairs(of: Column) -> Column:
    rest = F.greatest(F.size(of) - 1, F.lit(0))
    return F.zip_with(F.slice(of, F.lit(1), rest), F.slice(of, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b))


def features(of: Column) -> Column:
    return F.array_distinct(F.concat(of, pairs(of)))


def telling_words() -> list[str]:
    """The words of the notices but plain ones and numbers."""
    found = {w for _, notice in NOTICES for w in _words(notice)}
    return sorted(w for w in found if w not in PLAIN and not w.isdigit())


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() or c == "+" else " " for c in text.lower()).split()


def _pairs(text: str) -> list[str]:
    found = _words(text)
    return [f"{a} {b}" for a, b in zip(found, found[1:])]


def _telling(pair: str, telling: set[str]) -> bool:
    return not telling.isdisjoint(pair.split())


def _strong_pairs() -> list[str]:
    telling = set(telling_words())
    return sorted({p for _, t in NOTICES for p in _pairs(t) if telling.issuperset(p.split())})


def key_pairs(share: float) -> list[str] | None:
    """So many telling pairs of each notice that a text without any of them has not ``share`` of it.

    Pairs of two telling words come first, as others are commoner.  None where a text
    may hold the share of a notice without any pair.
    """
    telling, found = set(telling_words()), set()
    for _, notice in NOTICES:
        wanted = sorted({p for p in _pairs(notice) if _telling(p, telling)}, key=lambda p: (not telling.issuperset(p.split()), p))
        enough = [n for n in range(len(wanted) + 1) if n / len(wanted) >= share]
        if enough and not enough[0]:
            return None
        found.update(wanted[: len(wanted) - enough[0] + 1] if enough else [])
    return sorted(found)


# Between two words, and across the end of a line, where one comment mark may stand.
BETWEEN = "[^a-z0-9+]++"
ACROSS = f"{BETWEEN}(?:(?:dnl|rem){BETWEEN})?"


def _whole(options: dict[str, str]) -> str:
    """A pattern of whole words, each with what follows it; tried by their first letters."""
    letters: dict[str, list[str]] = {}
    for word, behind in sorted(options.items()):
        letters.setdefault(word[0], []).append(re.escape(word[1:]) + behind)
    either = "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in letters.items())
    return f"(?<![a-z0-9+])(?:{either})(?![a-z0-9+])"


def has_word(text: Column, of: list[str]) -> Column:
    """Whether one of the words is among those of the text."""
    return F.lower(text).rlike(_whole(dict.fromkeys(of, "")))


def may_have_pair(text: Column, of: list[str] | None, between: str = BETWEEN) -> Column:
    """Whether one of the pairs is among those of the text; always where there is no list."""
    if of is None:
        return F.lit(True)
    behind: dict[str, list[str]] = {}
    for first, second in (pair.split() for pair in of):
        behind.setdefault(first, []).append(re.escape(second))
    if not behind:
        return F.lit(False)
    return F.lower(text).rlike(_whole({first: f"{between}(?:{'|'.join(rest)})" for first, rest in behind.items()}))


def _table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table written into the plan."""
    arrays = [F.struct(*[F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)) for v in row]) for row in rows]
    columns = [F.col(f"r.col{n + 1}").alias(name) for n, name in enumerate(names.split())]
    return spark.range(1).select(F.explode(F.array(*arrays)).alias("r")).select(*columns)


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, paragraph (from 0) and line of every line of every row."""
    lines = F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("paragraph", "line")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), lines)


def wrapped(docs: DataFrame, share: float, id_col: str, text_col: str) -> DataFrame:
    """Families held by several lines together: doc_id, paragraph, last_paragraph, line, family and similarity."""
    telling = telling_words()
    told = F.array(*map(F.lit, telling))
    wanted = [(f, sorted({p for p in _pairs(t) if _telling(p, set(telling))})) for f, t in NOTICES]
    notices = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*map(F.lit, w)).alias("wanted")) for f, w in wanted])
    # Of the lines behind the first, twice the words of the longest notice.
    most = 2 * max(len(_words(t)) for _, t in NOTICES)
    # A list of one binds a value, so that it is made once.
    bound = lambda value, use: F.transform(F.array(value), use)[0]

    def part(line: Column) -> Column:
        bare = F.regexp_replace(line, MARK, "")
        return bound(
            words(bare),
            lambda w: F.struct(F.trim(bare).alias("bare"), F.size(w).alias("n"), F.arrays_overlap(w, told).alias("told")),
        )

    def state(lines: Column, n: Column, open_: Column) -> Column:
        return F.struct(lines.alias("lines"), n.alias("n"), open_.alias("open"))

    def from_line(parts: Column, first: Column, at: Column) -> Column:
        joined = F.aggregate(
            F.slice(parts, at + 2, most),
            state(F.array(first["bare"]), F.lit(0), F.lit(True)),
            lambda a, x: F.when(
                a["open"] & (x["n"] > 0) & (a["n"] < most),
                state(F.concat(a["lines"], F.array(x["bare"])), a["n"] + x["n"], F.lit(True)),
            ).otherwise(state(a["lines"], a["n"], F.lit(False))),
            lambda a: a["lines"],
        )
        ahead = F.coalesce(F.get(parts, at + 1)["told"], F.lit(False))
        return F.when((first["n"] > 0) & (first["told"] | ahead), joined)

    def held(text: Column) -> Column:
        """Notices of which the text holds the share, with the pairs found."""
        found = bound(
            pairs(words(text)),
            lambda mine: F.transform(
                notices,
                lambda x: bound(
                    F.array_intersect(x["wanted"], mine),
                    lambda both: F.struct((F.size(both) / F.size(x["wanted"])).alias("similarity"), x["family"].alias("family"), both.alias("found")),
                ),
            ),
        )
        return F.filter(found, lambda x: x["similarity"] >= share)

    keys = key_pairs(share)
    docs = docs.filter(may_have_pair(F.col(text_col).cast("string"), keys, ACROSS))
    parts = F.transform(F.split(F.col(text_col).cast("string"), "\n"), part)
    joined = bound(parts, lambda all_: F.transform(all_, lambda first, at: from_line(all_, first, at)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), joined.alias("joined"))
    rows = rows.select("doc_id", "row", F.posexplode("joined").alias("paragraph", "lines")).filter(F.size("lines") > 1)
    rows = rows.withColumn("line", F.array_join("lines", " ")).filter(may_have_pair(F.col("line"), keys))
    rows = rows.withColumn("held", held(F.col("line")))
    rows = rows.filter(F.size("held") > 0)
    alone = F.flatten(F.transform("lines", lambda line: F.transform(held(line), lambda x: x["family"])))
    rows = rows.withColumn("alone", F.array_distinct(alone))

    def part_of_another(x: Column) -> Column:
        larger = lambda y: (F.size(y["found"]) > F.size(x["found"])) & (y["family"] != x["family"])
        return F.exists("held", lambda y: larger(y) & (F.size(F.array_except(x["found"], y["found"])) == 0))

    kept = F.filter("held", lambda x: ~F.array_contains("alone", x["family"]) & ~part_of_another(x))
    rows = written(rows.select("doc_id", "row", "paragraph", F.size("lines").alias("n"), "line", kept.alias("held")), "wrapped")
    each = rows.select("doc_id", "row", "paragraph", "n", "line", F.explode("held").alias("x"))
    each = each.groupBy("row", "paragraph", F.col("x.family").alias("family")).agg(
        F.max("x.similarity").alias("similarity"), *[F.first(c).alias(c) for c in ("doc_id", "n", "line")]
    )
    by_place = Window.partitionBy("row", "family").orderBy("paragraph")
    beside = lambda step: F.coalesce(
        F.when(F.lag("paragraph", step).over(by_place) == F.col("paragraph") - step, F.lag("similarity", step).over(by_place)), F.lit(0.0)
    )
    each = each.withColumn("before", beside(1)).withColumn("behind", beside(-1))
    each = each.filter((F.col("similarity") > F.col("behind")) & (F.col("similarity") >= F.col("before")))
    last = (F.col("paragraph") + F.col("n") - 1).alias("last_paragraph")
    return each.select("doc_id", "paragraph", last, "line", "family", "similarity")


def _sample(docs: DataFrame, id_col: str, text_col: str, sample_docs: int) -> DataFrame:
    """Lines of a bounded sample of documents."""
    order = F.xxhash64(F.col(id_col).cast("long"))
    chosen = docs.select(order.alias("chosen")).distinct().orderBy("chosen").limit(sample_docs)
    # sample_docs numbers.
    some = docs.join(F.broadcast(chosen), order == F.col("chosen"))
    return paragraphs(some, id_col, text_col).select("line")


class Classifier:
    """Weights per feature and class, the last class being the unknown one."""

    def __init__(self, spark: SparkSession, sample: DataFrame):
        self.classes = [*dict.fromkeys(family for family, _ in NOTICES), UNKNOWN]
        known = [*[n for _, n in NOTICES], *OTHERS]
        self.vocabulary = sorted({g for t in known for g in (*_words(t), *_pairs(t))})
        number = {name: n for n, name in enumerate(self.classes)}
        labelled = [(number[f], t, 50.0) for f, t in NOTICES] + [(number[UNKNOWN], t, 20.0) for t in OTHERS]
        given = _table(spark, [(float(a), b, c) for a, b, c in labelled], "label line weight")
        sample = sample.filter(~self.suspect(words(F.col("line"))))
        unknown = sample.select(F.lit(float(number[UNKNOWN])).alias("label"), "line", F.lit(1.0).alias("weight"))
        rows = given.union(unknown).withColumn("grams", features(words(F.col("line"))))
        vector = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="grams", outputCol="features")
        fit = LogisticRegression(
            family="multinomial", weightCol="weight", regParam=2e-4, elasticNetParam=0.5, maxIter=60
        ).fit(vector.setBinary(True).transform(rows.repartition(2)).select("label", "features", "weight"))
        self.weights = fit.coefficientMatrix.toArray()
        self.bias = fit.interceptVector.toArray().tolist()
        self.table = _table(
            spark,
            [(g, [float(x) for x in self.weights[:, n]]) for n, g in enumerate(self.vocabulary) if self.weights[:, n].any()]
            or [("", [0.0] * len(self.classes))],
            "gram weights",
        )

    def suspect(self, of: Column) -> Column:
        """Whether the words may be a notice: they have half of one, or two telling words of one in a row."""
        strong = F.array(*map(F.lit, _strong_pairs()))
        return F.arrays_overlap(pairs(of), strong) | (F.coalesce(self.similarity(of), F.lit(0.0)) >= 0.5)

    def calibrate(self, scored: DataFrame, lines: int, false_alarms: float) -> float:
        """Raise the unknown bias, given the margins of all lines with telling words, and how many lines there are."""
        # Few lines have a pair that a suspect one must have; only they are compared.
        hint = may_have_pair(F.col("line"), sorted({*_strong_pairs(), *key_pairs(0.5)}))
        suspect = hint & self.suspect(words(F.col("line")))
        step = F.when(~suspect & (F.col("margin") > 0), F.floor(F.col("margin") * 1024).cast("long"))
        # As many rows as margins have steps.
        steps = scored.groupBy(suspect.alias("suspect"), step.alias("step")).count().collect()
        allowed = int(false_alarms * (lines - sum(r["count"] for r in steps if r["suspect"])))
        raised = 0.0
        for row in sorted((r for r in steps if r["step"] is not None), key=lambda r: -r["step"]):
            allowed -= row["count"]
            if allowed < 0:
                raised = (row["step"] + 1) / 1024
                break
        self.bias[-1] += raised
        return raised

    def logits(self, rows: DataFrame, key: list[str]) -> DataFrame:
        """The rows' keys and an array of one logit per class; ``rows`` has the key and words."""
        grams = rows.select(*key, F.explode_outer(features(F.col("words"))).alias("gram"))
        # The weights are bounded by the notices' words.
        weighed = grams.join(F.broadcast(self.table), "gram", "left")
        sums = [
            (F.coalesce(F.sum(F.col("weights")[n]), F.lit(0.0)) + F.lit(b)).alias(f"logit{n}")
            for n, b in enumerate(self.bias)
        ]
        found = weighed.groupBy(*key).agg(*sums)
        return found.select(*key, F.array(*[f"logit{n}" for n in range(len(self.bias))]).alias("logits"))

    def similarity(self, of: Column, family: Column | None = None) -> Column:
        """The largest share of a notice's telling word pairs that the words hold, of the family or of any."""
        telling = set(telling_words())
        mine, best = pairs(of), []
        for name, notice in NOTICES:
            wanted = sorted({p for p in _pairs(notice) if _telling(p, telling)})
            share = F.size(F.array_intersect(mine, F.array(*map(F.lit, wanted)))) / len(wanted)
            best.append(share if family is None else F.when(family == name, share).otherwise(F.lit(0.0)))
        return F.greatest(*best)


def scan_licences(
    docs: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    false_alarms: float = FALSE_ALARMS,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Lines that are named a family, and lines that hold a wrapped notice together.

    doc_id, paragraph, line, family, probability, similarity, confirmed, version, last_paragraph;
    a single line ends in the paragraph it begins in.
    """
    spark = docs.sparkSession
    model = Classifier(spark, _sample(docs, id_col, text_col, sample_docs))
    lines = written(paragraphs(docs, id_col, text_col).filter(has_word(F.col("line"), telling_words())), "lines")
    # Equal lines are scored once; the join brings them back to their places.
    distinct = lines.select("line").distinct().withColumn("words", words(F.col("line")))
    logits = model.logits(distinct, ["line"])
    classes = F.array(*map(F.lit, model.classes))
    known = F.slice("logits", 1, len(model.classes) - 1)
    top = F.array_max(known)
    others = F.aggregate(known, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    family = F.element_at(classes, F.array_position(known, top).cast("int"))
    margin = top - F.element_at("logits", -1)
    scored = written(logits.select("line", family.alias("family"), margin.alias("margin"), others.alias("others")), "margins")
    every = paragraphs(docs, id_col, text_col).select(F.xxhash64("line")).distinct().count()
    raised = model.calibrate(scored, every, false_alarms)
    probability = 1 / (F.col("others") + F.exp(raised - F.col("margin")))
    named = scored.filter(F.col("margin") >= raised).select("line", "family", probability.alias("probability"))
    alike = model.similarity(words(F.col("line")), F.col("family"))
    named = named.withColumn("similarity", alike)
    single = lines.select("doc_id", "paragraph", F.col("paragraph").alias("last_paragraph"), "line").join(named, "line")

    joined = written(wrapped(docs, share, id_col, text_col), "notices")
    texts = joined.select("line").distinct().withColumn("words", words(F.col("line")))
    mine = F.element_at("logits", F.array_position(classes, F.col("family")).cast("int"))
    top = F.array_max("logits")
    total = F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    several = joined.join(model.logits(texts, ["line"]), "line").withColumn("probability", F.exp(mine - top) / total)

    version = F.regexp_extract(F.lower("line"), r"(?:version |v\. ?|v|[a-z0] )([0-9]+(?:\.[0-9]+)*)", 1)
    found = single.unionByName(several.drop("logits")).withColumn("confirmed", F.col("similarity") >= share)
    return found.withColumn("version", F.nullif(version, F.lit(""))).select(
        "doc_id", "paragraph", "line", "family", "probability", "similarity", "confirmed", "version", "last_paragraph"
    )


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all documents that are named a licence family, wrapped notices included."""
    return scan_licences(read(spark, sf_dir, "documents"))
