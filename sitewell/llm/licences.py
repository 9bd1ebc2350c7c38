"""Licence scan: a trained classifier of paragraphs, confirmed against templates.

A paragraph is a line. Its words are lower-cased runs of letters, digits, `.`, `-`; those outside the
vocabulary (the words of the licence examples, common words apart) are skipped. Runs of one to three of the
remaining words are hashed into the features of a multinomial logistic regression over licence families and
the class `unknown`. Probabilities are calibrated by a temperature, chosen on every third example by a model
that has not seen it. A family other than unknown is confirmed if enough word pairs of the paragraph and of
one of the family's templates agree. Paragraphs without a word of the vocabulary have no features and are
unknown; they are passed over before anything is scored, and lose nothing by that.

Defined results: null and empty texts have no paragraphs to report; paragraphs of any length are read whole;
repeated rows are reported each. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.llm.common import constants, once

BUCKETS = 4096
CONFIRMED = 0.5
UNKNOWN = "unknown"
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)
COMMON = frozenset((
    "the of and to in a is that it for on was with as be by this are from at or an not you his her have der die das "
    "und den von zu mit le la les de des du et en un une que el los las y se no all any may can under use used has "
    "but they were one we he she its our your their there which who what when if so do does had been will would more "
    "most than then them other into over after before new time day year people").split())

# Fixed wording of public licence notices; all of a family's are its templates too.
NOTICES = {
    "MIT": """Released under the MIT License.
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.
Licensed under the MIT license. See the LICENSE file for details.
The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability.
This project is distributed under the terms of the MIT License.
MIT licensed. The MIT License (MIT)
Code is available under the MIT License.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0.
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS.
This product is released under the Apache 2.0 license.
SPDX-License-Identifier: Apache-2.0
Apache License Version 2.0, January 2004""",
    "GPL": """This work is licensed under the GNU General Public License, version 3.
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.
You should have received a copy of the GNU General Public License along with this program.
Licensed under the GPL version 2 or later.
Distributed under the terms of the GNU GPL v3.
SPDX-License-Identifier: GPL-3.0-or-later
This library is free software under the GNU Lesser General Public License, version 2.1.""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.
Released under the BSD 3-Clause License.
Licensed under the 2-clause BSD license.
SPDX-License-Identifier: BSD-3-Clause
Distributed under the New BSD License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, you can obtain one at http://mozilla.org/MPL/2.0/.
Licensed under the Mozilla Public License, version 2.0.
SPDX-License-Identifier: MPL-2.0""",
    "CC-BY-NC": """Licensed under CC BY-NC 4.0.
This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.
Licensed under the Creative Commons Attribution-NonCommercial-ShareAlike license, CC BY-NC-SA 4.0.
CC BY-NC 3.0. For noncommercial use only.
Content is available under CC BY-NC-ND 4.0 unless otherwise noted.""",
    "CC-BY": """Licensed under CC BY 4.0.
This work is licensed under a Creative Commons Attribution 4.0 International License.
Text is available under the Creative Commons Attribution-ShareAlike License, CC BY-SA 3.0.
Content is available under CC BY-SA 4.0 unless otherwise noted.
Creative Commons Attribution 4.0. CC BY 4.0.""",
    "CC0": """To the extent possible under law, the author has waived all copyright and related rights to this work.
This work is dedicated to the public domain under CC0 1.0 Universal.
Released into the public domain. CC0.
SPDX-License-Identifier: CC0-1.0""",
    "proprietary": """All rights reserved.
Copyright 2020 Example Corporation. All rights reserved.
No part of this publication may be reproduced or transmitted in any form without prior written permission of the publisher.
Alle Rechte vorbehalten.
Tous droits réservés.
Todos los derechos reservados.
This document is confidential and proprietary; unauthorized copying is prohibited.
Copyright 2019 by the author. All rights are reserved.""",
    UNKNOWN: """He renewed his driving license at the office last week.
The license plate of the car was hard to read.
A license is required to sell food at the market.
The second version of the story is the better one.
Version 2.0 of the game is out and it is free.
The work of the foundation is known in the whole country.
She teaches general history at a public school.
The public library is free and open on Sunday.
They work under hard conditions and without a break.
The apache helicopter was parked in the hall.
Students at MIT built a small robot.
All the rooms are reserved for the weekend.
We reserved a table for four in the name of my brother.
Human rights are the subject of the lecture.
Civil rights groups asked the court to act.
Copyright law is taught in the third year.
The author gave permission to read the letter aloud.
A creative person needs time and some luck.
The commons were open land that everybody could use.
Please read the terms and conditions of the hotel.
The product is distributed in every state.
The software runs on a small computer.
Source code is read more often than it is written.
The file was lost and no copy remained.
A warranty of two years comes with the phone.
The domain of the function is the whole line.
An attribution of the painting to her is in doubt.
Commercial fishing is limited in this lake.
The international train leaves at noon.
A notice on the door said closed.
The holder of the ticket may enter once.
The project was presented in January 2004.
You can obtain the form at the desk.
The list of names is kept in the drawer.
The law was agreed to in writing after a long debate.
The document describes the history of the form.
The publication of the book was delayed.
Binary numbers use two digits only.
The mozilla conference was held in Berlin.
The extent of the damage is not known.
The clause at the end of the sentence is long.
Identifier and value are written on one line.
The available seats are shown on the map.
Details are found in the next chapter.""",
}
CLASSES = tuple(NOTICES)


def _python_words(text: str) -> list[str]:
    return [w.strip(".-") for w in re.split(r"[^\w.\-]+", text.lower()) if w.strip(".-")]


VOCABULARY = tuple(sorted({w for family, notices in NOTICES.items() if family != UNKNOWN
                           for w in _python_words(notices)} - COMMON))


def kept_words(text: Column) -> Column:
    """The words of the vocabulary, in order."""
    words = F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}_.\-]+"), lambda w: F.regexp_replace(w, r"^[.\-]+|[.\-]+$", ""))
    return F.filter(words, lambda w: w.isin(*VOCABULARY))


def _runs(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def features(words: Column) -> Column:
    """Buckets of the different runs of one, two and three kept words."""
    return F.array_distinct(F.transform(F.concat(*[_runs(words, n) for n in (1, 2, 3)]),
                                        lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def examples(spark: SparkSession) -> DataFrame:
    """n, label (number of the class), text: the small labelled table."""
    rows = [{"label": float(k), "text": line} for k, family in enumerate(CLASSES) for line in NOTICES[family].split("\n")]
    rows = [{"n": n} | r for n, r in enumerate(rows)]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<n:int,label:double,text:string>>")))


class Model:
    """Weights by class and bucket, intercepts, temperature."""

    def __init__(self, weights: list[list[float]], intercepts: list[float], temperature: float = 1.0):
        self.weights, self.intercepts, self.temperature = weights, intercepts, temperature

    def probabilities(self, feats: Column, temperature: Column | None = None) -> Column:
        """Array of probabilities in the order of CLASSES. `feats` should be a column, not an expression."""
        t = F.lit(self.temperature) if temperature is None else temperature
        tables, tops = constants([w for row in self.weights for w in row]), constants(self.intercepts)
        logits = F.transform(tops, lambda top, k: F.exp(F.aggregate(
            feats, top, lambda total, b: total + F.get(tables, k * BUCKETS + b)) / t))
        return F.get(F.transform(F.array(logits), lambda e: F.transform(
            e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))), F.lit(0))


def _fit(rows: DataFrame, strength: float) -> Model:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    dense = F.get(F.transform(F.array(features(kept_words(F.col("text")))), lambda b: F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.array_contains(b, i).cast("double"))), F.lit(0))
    model = LogisticRegression(family="multinomial", regParam=strength, maxIter=60, standardization=False).fit(
        rows.coalesce(1).select("label", array_to_vector(dense).alias("features")))
    return Model([[round(float(w), 5) for w in row] for row in model.coefficientMatrix.toArray()],
                 [round(float(b), 5) for b in model.interceptVector])


def fit(spark: SparkSession, strength: float = 0.001) -> Model:
    """The model of all examples, at the temperature with the least loss on examples held out."""
    rows = examples(spark)
    partial = _fit(rows.where("n % 3 <> 0"), strength)
    held = rows.where("n % 3 = 0").select("label", features(kept_words(F.col("text"))).alias("f"),
                                          F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])).alias("t"))
    chance = F.get(partial.probabilities(F.col("f"), F.col("t")), F.col("label").cast("int"))
    best = held.select("t", F.log(F.greatest(chance, F.lit(1e-9))).alias("gain")).groupBy("t").agg(
        F.avg("gain").alias("gain")).orderBy(F.desc("gain"), "t").first()
    model = _fit(rows, strength)
    model.temperature = best["t"]
    return model


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, paragraph (number from 1), text, family, probability, similarity, confirmed: every paragraph
    whose most probable class is a licence family."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))
    words = lines.select("*", F.explode(F.filter(F.array(kept_words(F.col("text"))), lambda w: F.size(w) > 0)).alias("words"))
    scored = words.select("*", once(features(F.col("words"))).alias("f")).select(
        "*", once(model.probabilities(F.col("f"))).alias("p")).withColumn(
        "k", F.array_position("p", F.array_max("p")).cast("int") - 1).where(F.col("k") != CLASSES.index(UNKNOWN))
    pairs = [[[" ".join(w[i:i + 2]) for i in range(max(1, len(w) - 1))] for w in (
        [x for x in _python_words(line) if x in VOCABULARY] for line in NOTICES[c].split("\n"))]
        for c in CLASSES if c != UNKNOWN]  # the last class
    array = lambda values: F.array(*values)
    templates = F.get(array([array([array([F.lit(x) for x in t]) for t in c]) for c in pairs]), F.col("k"))
    own = F.when(F.size("words") < 2, F.col("words")).otherwise(F.array_distinct(_runs(F.col("words"), 2)))
    scored = scored.select("*", once(own).alias("own"))
    alike = F.array_max(F.transform(templates, lambda t: F.size(F.array_intersect(F.col("own"), t)) / F.least(
        F.size("own"), F.size(F.array_distinct(t)))))
    names = F.array(*[F.lit(c) for c in CLASSES])
    return scored.select("doc_id", (F.col("paragraph") + 1).alias("paragraph"), "text", F.get(names, F.col("k")).alias("family"),
                         F.round(F.array_max("p"), 6).alias("probability"), F.round(alike, 6).alias("similarity")).withColumn(
        "confirmed", F.col("similarity") >= CONFIRMED)


def query(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text"), fit(docs.sparkSession)).drop("text")
