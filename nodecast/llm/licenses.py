"""License scan by diagonal voting.

Templates are word sequences.  Every place of a document whose rolling word
k-gram equals a template's k-gram casts a vote for the diagonal (place in the
document minus place in the template).  Votes are counted by diagonal;
diagonals of one template at most ``SLACK`` apart are merged, so that a few
added or missing words do not break a passage; a merged diagonal that holds
``ENOUGH`` of the template's k-grams is a verified span.

The base phrases are templates too.  For them only a complete single diagonal
counts, which is a place where exactly their words stand.

All of it is DataFrame work: the templates' k-grams are a fixed small table, so
the documents' words are never shuffled, only the votes.

Null, empty and wordless texts have no words, labels or places and score 0.
Repeated rows each get their row.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from nodecast.llm.words import gram, n_words, words

# fixed values: the base phrases and their labels
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# fixed values: paragraphs of public licenses and their notices.  Each is a template of its
# own, so that a paragraph added or left out between them takes no other along.
PASSAGES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit-notice", "released under the mit license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files the software to deal in the software without"
     " restriction"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or"
     " without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms"
     " of the gnu general public license as published by the free software foundation"),
    ("mit-rights", "including without limitation the rights to use copy modify merge publish distribute sublicense and"
     " or sell copies of the software and to permit persons to whom the software is furnished to do so"
     " subject to the following conditions"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial"
     " portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not"
     " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in"
     " no event shall the authors or copyright holders be liable for any claim damages or other liability"
     " whether in an action of contract tort or otherwise arising from out of or in connection with the"
     " software or the use or other dealings in the software"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and"
     " the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and"
     " the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
     " promote products derived from this software without specific prior written permission"),
    ("bsd-warranty", "this software is provided by the copyright holders and contributors as is and any express or implied"
     " warranties including but not limited to the implied warranties of merchantability and fitness for a"
     " particular purpose are disclaimed in no event shall the copyright holder or contributors be liable"
     " for any direct indirect incidental special exemplary or consequential damages including but not"
     " limited to procurement of substitute goods or services loss of use data or profits or business"
     " interruption however caused and on any theory of liability whether in contract strict liability or"
     " tort including negligence or otherwise arising in any way out of the use of this software even if"
     " advised of the possibility of such damage"),
    ("isc-condition", "provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-warranty", "the software is provided as is and the author disclaims all warranties with regard to this software"
     " including all implied warranties of merchantability and fitness in no event shall the author be"
     " liable for any special direct indirect or consequential damages or any damages whatsoever resulting"
     " from loss of use data or profits whether in an action of contract negligence or other tortious"
     " action arising out of or in connection with the use or performance of this software"),
    ("zlib-warranty", "this software is provided as is without any express or implied warranty in no event will the authors"
     " be held liable for any damages arising from the use of this software"),
    ("zlib-text", "permission is granted to anyone to use this software for any purpose including commercial"
     " applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("zlib-origin", "the origin of this software must not be misrepresented you must not claim that you wrote the"
     " original software"),
    ("zlib-altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the"
     " original software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense-text", "anyone is free to copy modify publish use compile sell or distribute this software either in source"
     " code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("unlicense-dedication", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any"
     " and all copyright interest in the software to the public domain we make this dedication for the"
     " benefit of the public at large and to the detriment of our heirs and successors"),
    ("boost-text", "permission is hereby granted free of charge to any person or organization obtaining a copy of the"
     " software and accompanying documentation covered by this license the software to use reproduce"
     " display distribute execute and transmit the software and to prepare derivative works of the software"
     " and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("apache-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license"
     " at"),
    ("apache-warranty", "unless required by applicable law or agreed to in writing software distributed under the license is"
     " distributed on an as is basis without warranties or conditions of any kind either express or implied"
     " see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty without even"
     " the implied warranty of merchantability or fitness for a particular purpose see the gnu general"
     " public license for more details"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program"),
)
SHORT, LONG = 2, 5
"""Words in a k-gram of a base phrase and of a passage."""
SLACK, ENOUGH = 3, 0.8


def grams(spark: SparkSession) -> DataFrame:
    """``template, label, base, k, n_grams, tpos, token, gram``: each k-gram of
    each template, keyed by the hash of its first two words."""
    rows = [(label, True, SHORT, text) for label, text in BASE]
    rows += [(label, False, LONG, text) for label, text in PASSAGES]
    values = ", ".join(f"({i}, '{a}', {str(b).lower()}, {k}, '{t}')" for i, (a, b, k, t) in enumerate(rows))
    templates = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, base, k, text)")
    placed = templates.withColumn("words", F.split("text", " ")).withColumn(
        "n_grams", F.size("words") - F.col("k") + 1
    )
    placed = placed.withColumn("pos", F.explode(F.expr("sequence(0, n_grams - 1)")))
    return placed.select(
        "template", "label", "base", "k", "n_grams", F.col("pos").alias("tpos"),
        gram(SHORT).alias("token"),
        F.array_join(F.expr("slice(words, pos + 1, k)"), " ").alias("gram"),
    )


def diagonals(documents: DataFrame) -> DataFrame:
    """``key, mark, template, label, base, n_grams, diagonal, places``: the
    votes of each diagonal, as the template places that are matched there."""
    spark = documents.sparkSession
    placed = documents.withColumn(
        "pos", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - SHORT, F.lit(0))))
    ).withColumn("token", gram(SHORT))
    met = placed.join(F.broadcast(grams(spark)), "token")  # a fixed table
    votes = met.where(F.array_join(F.expr("slice(words, pos + 1, k)"), " ") == F.col("gram"))
    return votes.groupBy(
        "key", "mark", "template", "label", "base", "n_grams", (F.col("pos") - F.col("tpos")).alias("diagonal")
    ).agg(F.collect_set("tpos").alias("places"))


def spans(voted: DataFrame) -> DataFrame:
    """``key, mark, template, label, coverage``: merged diagonals and the share of the
    template's k-grams on them."""
    series = Window.partitionBy("key", "mark", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(series) > SLACK, F.lit(True))
    merged = voted.withColumn("apart", apart).withColumn("span", F.sum(F.col("apart").cast("int")).over(series))
    held = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    return merged.groupBy("key", "mark", "template", "label", "n_grams", "span").agg(held.alias("held")).select(
        "key", "mark", "template", "label", (F.col("held") / F.col("n_grams")).alias("coverage")
    )


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` per row.  ``score`` is the largest share of a template's k-grams
    found on one merged diagonal."""
    mark = F.xxhash64(F.col(text)).alias("mark")  # tells rows that share a key apart
    rows = documents.select(F.col(key).alias("key"), mark, n_words(F.col(text)).alias("n_words"))
    voted = diagonals(
        documents.select(F.col(key).alias("key"), mark, words(F.col(text)).alias("words"))
    )
    whole = F.col("base") & (F.size("places") == F.col("n_grams"))
    complete = voted.where(whole).select("key", "mark", "label", "diagonal", F.lit(1.0).alias("coverage"))
    passages = spans(voted.where(~F.col("base"))).select(
        "key", "mark", "label", F.lit(None).cast("int").alias("diagonal"), "coverage"
    )
    base = F.col("diagonal").isNotNull()
    labelled = F.when(F.col("coverage") >= ENOUGH, F.col("label"))
    found = complete.unionByName(passages).groupBy("key", "mark").agg(
        F.count("diagonal").alias("n_base"),
        F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(labelled)), ",").alias("labels"),
        F.max("coverage").alias("score"),
    ).withColumnsRenamed({"key": "side_key", "mark": "side_mark"})
    same = F.col("key").eqNullSafe(F.col("side_key")) & (F.col("mark") == F.col("side_mark"))
    return rows.join(found, same, "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
