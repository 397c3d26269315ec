"""Licence scans: known sentences become identifiers, and rules are sequences of these."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, as they read in lower case with
# every run of other characters than a-z and 0-9 as one space.
SENTENCES = {
    "licensed under the apache license version 2 0 the license": "apache-header",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "this is free and unencumbered software released into the public domain": "unlicense-domain",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd-liability",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-only-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-grant",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu lesser general public license for more details": "gpl-see",
    "see the gnu affero general public license for more details": "gpl-see",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-header",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-header",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-header",
    "this software is provided as is without any express or implied warranty": "zlib-as-is",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "distributed under the boost software license version 1 0": "bsl1-named",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl1-grant",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-dedication",
}

# Licences as a sentence names them, with the identifier of such sentences.
NAMED = [
    ("GPL-3.0-only", "gpl3-named", ["gnu general public license version 3", "gpl 3 0", "gplv3"]),
    ("GPL-2.0-only", "gpl2-named", ["gnu general public license version 2", "gpl 2 0", "gplv2"]),
    ("LGPL-3.0-only", "lgpl3-named", ["gnu lesser general public license version 3", "lgpl 3 0", "lgplv3"]),
    ("LGPL-2.1-only", "lgpl21-named", ["gnu lesser general public license version 2 1", "lgpl 2 1", "lgplv2 1"]),
    ("AGPL-3.0-only", "agpl3-named", ["gnu affero general public license version 3", "agpl 3 0", "agplv3"]),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-named", ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"]),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-named", ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"]),
    ("CC-BY-NC-4.0", "cc-by-nc-named", ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"]),
    ("CC-BY-SA-4.0", "cc-by-sa-named", ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"]),
    ("CC-BY-ND-4.0", "cc-by-nd-named", ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"]),
    ("CC-BY-4.0", "cc-by-named", ["cc by 4 0", "creative commons attribution 4 0 international license"]),
    ("CC0-1.0", "cc0-named", ["cc0 1 0", "cc0 1 0 universal"]),
    ("Apache-2.0", "apache-named", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"]),
    ("MIT", "mit-named", ["mit license"]),
    ("ISC", "isc-named", ["isc license"]),
    ("BSD-3-Clause", "bsd3-named", ["bsd 3 clause license", "3 clause bsd license"]),
    ("BSD-2-Clause", "bsd2-named", ["bsd 2 clause license", "2 clause bsd license"]),
    ("MPL-2.0", "mpl2-named", ["mozilla public license version 2 0", "mpl 2 0"]),
    ("EPL-2.0", "epl2-named", ["eclipse public license version 2 0", "epl 2 0"]),
    ("Zlib", "zlib-named", ["zlib license"]),
    ("BSL-1.0", "bsl1-named", ["boost software license version 1 0"]),
    ("Unlicense", "unlicense-named", ["unlicense"]),
]
NAMING = [f"{who}{verb} under {kind}" for who in ("", "this work is ", "this project is ", "this software is ") for verb in ("licensed", "released", "distributed") for kind in ("", "the ", "a ")]

# Licences and the sentences that show them, one directly after the other. A rule
# takes its sentences away from the ones after it. True: the text may be cut short here, so the
# rule does not hold where a sentence that is not known follows.
TEXTS = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"], False),
    ("MIT", ["mit-grant", "mit-notice"], True),
    ("Apache-2.0", ["apache-header", "apache-compliance", "apache-copy", "apache-as-is", "apache-see"], False),
    ("Apache-2.0", ["apache-header", "apache-compliance"], False),
    ("GPL-3.0-or-later", ["gpl3-grant", "gpl-warranty", "gpl-see"], False),
    ("GPL-3.0-or-later", ["gpl3-grant"], False),
    ("GPL-2.0-or-later", ["gpl2-grant"], False),
    ("GPL-2.0-only", ["gpl2-only-grant"], False),
    ("LGPL-3.0-or-later", ["lgpl3-grant"], False),
    ("LGPL-2.1-or-later", ["lgpl21-grant"], False),
    ("AGPL-3.0-or-later", ["agpl3-grant"], False),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"], False),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"], True),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"], False),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], True),
    ("ISC", ["isc-grant", "isc-as-is"], False),
    ("ISC", ["isc-grant"], True),
    ("0BSD", ["0bsd-grant", "isc-as-is"], False),
    ("MPL-2.0", ["mpl2-header"], False),
    ("EPL-2.0", ["epl2-header"], False),
    ("Zlib", ["zlib-as-is", "zlib-liability", "zlib-grant"], False),
    ("BSL-1.0", ["bsl1-grant"], False),
    ("CC0-1.0", ["cc0-dedication"], False),
]


def _words(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def _known() -> dict[str, str]:
    """All known sentences: those of the texts, those that name a licence, and SPDX lines."""
    known = dict(SENTENCES)
    for _, own, names in NAMED:
        known |= {f"{naming}{name}": own for naming in NAMING for name in names}
    for name in dict.fromkeys([n for n, _, _ in TEXTS] + [n for n, _, _ in NAMED]):
        known[f"spdx license identifier {_words(name)}"] = f"spdx-{name.lower()}"
    return known


KNOWN = _known()
RULES = (
    TEXTS
    + [(name, [own], False) for name, own, _ in NAMED]
    + [("Unlicense", ["unlicense-domain"], False)]
    + [(name, [f"spdx-{name.lower()}"], False) for name in dict.fromkeys(n for n, _, _ in TEXTS + NAMED)]
)

# Parts of a sentence that name a holder or number a clause, and how the map has them.
FORMS = [
    (r"^(?:[0-9]+|[a-h]) (redistributions|neither) ", r"\1 "),
    (r"^neither the names? .* may be used to endorse ", "neither the name of the copyright holder nor the names of its contributors may be used to endorse "),
    (r"^this software is provided by .* as is and any express ", "this software is provided by the copyright holders and contributors as is and any express "),
    (r"^in no event shall .* be liable for any direct ", "in no event shall the copyright holder or contributors be liable for any direct "),
    (r"^in no event shall .* be liable for any claim ", "in no event shall the authors or copyright holders be liable for any claim "),
    (r"^(the above copyright notice and this permission notice) including the next paragraph ", r"\1 "),
]
FORMED = "^(?:[0-9]+ |[a-h] )?(?:redistributions|neither the|this software is provided by|in no event shall|the above copyright notice) "

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\r", "abcdefghijklmnopqrstuvwxyz "
#: Marks are set in lower-case text, one step after the other: H ends a sentence (after . ! ? before
#: white space, at a line without letters and digits, and around a line with a copyright or an
#: SPDX identifier), C stands for ':' or ';' before white space.
STEPS = [
    (r"\b(inc|ltd|corp)\.", r"\1"),
    (r"(\n[^a-z0-9\n]*(?:spdx-license-identifier|(?:copyright|\(c\)|©)[^a-z0-9\n]*(?:c\)|[0-9]))[^\n]*)", r"H\1H"),
    (r"""[.!?]["')\]]*[ \t\n]""", "H"),
    (r"\n[^a-z0-9]*\n", "H"),
    (r"[:;][ \t\n]", "C"),
]
#: Then L stands for a line break, and all else but a-z and 0-9 becomes one space.
REST = "[^a-z0-9HLC]+"
#: A line or piece that begins as a known sentence does, by its first three words.
OPENS = "[LC][LC ]*((?:" + "|".join(sorted({" ".join(s.split()[:3]) for s in KNOWN})) + ") )"
#: What a sentence that is not known is cut at, one after the other, while no piece is known.
CUTS = [(OPENS, r"H\1"), ("C", "H"), ("L", "H")]
#: Pieces that are neither known nor a clause: without letters, links, lines of rights.
IDLE = "^(?:[^a-z]*|https? .*|(?:copyright )?c? ?[0-9]+ .*|copyright c .*|all rights reserved)$"
#: The map is kept in this many small ones, by a checksum of the sentence.
MAPS = 256


def _replace(text: Column, step: tuple[str, str]) -> Column:
    return F.regexp_replace(text, step[0], step[1].replace("\\1", "$1"))


def _table() -> Column:
    maps: list[list[Column]] = [[F.lit(""), F.lit(None).cast("string")] for _ in range(MAPS)]
    for sentence, own in KNOWN.items():
        maps[zlib.crc32(sentence.encode()) % MAPS] += [F.lit(sentence), F.lit(own)]
    return F.array(*[F.create_map(*m) for m in maps])


def _looked_up(pieces: Column, table: Column) -> Column:
    """Each piece with its marks (raw), its plain form (p) and its identifier, null if not known."""
    found = F.transform(pieces, lambda x: F.struct(x.alias("raw"), F.trim(F.regexp_replace(x, "[ LC]+", " ")).alias("p")))

    def formed(x: Column) -> Column:
        text = x["p"]
        for form in FORMS:
            text = _replace(text, form)
        return F.struct(x["raw"].alias("raw"), F.when(x["p"].rlike(FORMED), text).otherwise(x["p"]).alias("p"))

    def named(x: Column) -> Column:
        own = F.try_element_at(F.get(table, F.pmod(F.crc32(x["p"]), F.lit(MAPS)).cast("int")), x["p"])
        return F.struct(x["raw"].alias("raw"), x["p"].alias("p"), own.alias("id"))

    return F.transform(F.transform(found, formed), named)


def _ids(pieces: Column, table: Column, cuts: list[tuple[str, str]]) -> Column:
    """The identifiers of pieces in order, '?' for what is not known."""

    def unknown(x: Column) -> Column:
        return F.when(x["p"].rlike(IDLE), F.array().cast("array<string>")).otherwise(F.array(F.lit("?")))

    def one(x: Column) -> Column:
        own = F.when(x["id"].isNotNull(), F.array(x["id"]))
        if not cuts:
            return own.otherwise(unknown(x))
        smaller: Callable[[], Column] = lambda: _ids(F.split(_replace(x["raw"], cuts[0]), "H", -1), table, cuts[1:])
        return own.when(~F.trim(x["raw"]).rlike("[LC]"), unknown(x)).otherwise(smaller())

    return F.flatten(F.transform(_looked_up(pieces, table), one))


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_sentences (those that hold a letter or digit),
    sentence_ids (those of the known ones in order, joined by commas), n_rules (how often rules
    match) and licenses (the names of matching rules, each once, in order of the rules, joined by
    commas).

    A sentence ends at . ! or ? before white space, at a line without letters and digits, and
    around a line with a copyright or an SPDX identifier; wrapped lines are one sentence. What the
    map does not hold is looked up in pieces: from lines that begin as a known sentence does, then
    between ':' and ';', then line by line. A rule wants its sentences directly one after the
    other; numbers of clauses, links and copyright lines between do not count. Holders' names are
    left out of clauses before they are looked up. SPDX lines are known where they name one licence.

    Whole texts, with no shuffle and no code outside the built-in functions. Null and empty texts
    have no sentences, an empty table gives no rows; repeated rows are scanned each; other columns
    are not read.
    """
    text = F.concat(F.lit("\n"), F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER))
    for step in STEPS:
        text = _replace(text, step)
    pieces = F.split(F.regexp_replace(F.translate(text, "\n", "L"), REST, " "), "H", -1)
    found = docs.select("doc_id", pieces.alias("pieces"))
    n_sentences = F.size(F.filter("pieces", lambda x: x.rlike("[a-z0-9]"))).cast("long")
    found = found.select("doc_id", n_sentences.alias("n_sentences"), _ids(F.col("pieces"), _table(), CUTS).alias("ids"))
    known = F.filter("ids", lambda i: i != "?")
    rule = [(F.lit(name).alias("name"), F.lit(_tags(ids)).alias("ids"), F.lit(cut).alias("cut")) for name, ids, cut in RULES]
    rules = F.array(*[F.struct(*r) for r in rule])
    nothing = F.array().cast("array<string>")

    def apply(state: Column, rule: Column) -> Column:
        cut_short = F.replace(state["left"], F.concat(rule["ids"], F.lit("<?>")), F.lit("@"))
        left = F.when(rule["cut"], cut_short).otherwise(state["left"])
        parts = F.split(left, F.concat(F.lit("\\Q"), rule["ids"], F.lit("\\E")), -1)
        hits = F.size(parts) - 1
        return F.struct(
            F.array_join(parts, "#").alias("left"),
            (state["n"] + hits).cast("long").alias("n"),
            F.concat(state["names"], F.when(hits > 0, F.array(rule["name"])).otherwise(nothing)).alias("names"),
        )

    tags = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    found = found.select("doc_id", "n_sentences", known.alias("known"), tags.alias("tags"))
    start = F.struct(F.col("tags").alias("left"), F.lit(0).cast("long").alias("n"), nothing.alias("names"))
    matched = F.when(F.size("known") > 0, F.aggregate(rules, start, apply)).otherwise(start)
    found = found.select("doc_id", "n_sentences", "known", matched.alias("m"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("known", ",").alias("sentence_ids"),
        F.col("m.n").alias("n_rules"),
        F.array_join(F.array_distinct("m.names"), ",").alias("licenses"),
    )


def _tags(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def replaced(text: str, step: tuple[str, str]) -> str:
        return f"regexp_replace({text}, {quoted(step[0])}, {quoted(step[1])}, 'g')"

    text = f"concat(chr(10), translate(coalesce(text, ''), '{UPPER[:-1]}' || chr(13), '{LOWER}'))"
    for step in STEPS:
        text = replaced(text, step)
    text = f"regexp_replace(replace({text}, chr(10), 'L'), '{REST}', ' ', 'g')"
    formed = "p"
    for form in FORMS:
        formed = replaced(formed, form)
    levels, ends = [], []
    for k in range(len(CUTS) + 1):
        source = f"(SELECT rid, [place] AS path, raw FROM (SELECT rid, unnest(pieces) AS raw, generate_subscripts(pieces, 1) AS place FROM s))"
        if k:
            source = (
                f"(SELECT rid, list_append(path, place) AS path, raw FROM (SELECT rid, path, unnest(pieces) AS raw, generate_subscripts(pieces, 1) AS place "
                f"FROM (SELECT rid, path, string_split({replaced('raw', CUTS[k - 1])}, 'H') AS pieces FROM l{k - 1} WHERE id IS NULL)))"
            )
        levels.append(
            f"l{k} AS MATERIALIZED (SELECT rid, path, raw, p, id FROM (SELECT rid, path, raw, CASE WHEN regexp_matches(p, '{FORMED}') THEN {formed} ELSE p END AS p "
            f"FROM (SELECT *, trim(regexp_replace(raw, '[ LC]+', ' ', 'g')) AS p FROM {source})) LEFT JOIN known ON p = sentence)"
        )
        ends.append(f"SELECT rid, path, id FROM l{k} WHERE id IS NOT NULL")
    last = f"l{len(CUTS)}"
    ends.append(f"SELECT rid, path, '?' FROM {last} WHERE id IS NULL AND NOT regexp_matches(p, '{IDLE}')")
    steps, before = [], "k"
    for k, (name, ids, cut) in enumerate(RULES):
        tags = _tags(ids)
        left = f"replace(left_, '{tags}<?>', '@')" if cut else "left_"
        steps.append(
            f"r{k} AS (SELECT doc_id, n_sentences, ids, replace({left}, '{tags}', '#') AS left_, "
            f"n + (len({left}) - len(replace({left}, '{tags}', ''))) // {len(tags)} AS n, "
            f"CASE WHEN contains({left}, '{tags}') THEN list_append(names, '{name}') ELSE names END AS names FROM {before})"
        )
        before = f"r{k}"
    table = ", ".join(f"('{sentence}', '{own}')" for sentence, own in KNOWN.items())
    return f"""
WITH known(sentence, id) AS (VALUES {table}),
s AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, string_split({text}, 'H') AS pieces FROM documents),
{', '.join(levels)},
f AS (SELECT rid, list(id ORDER BY path) AS ids FROM ({' UNION ALL '.join(ends)}) GROUP BY rid),
k AS (SELECT doc_id, len(list_filter(pieces, lambda x: regexp_matches(x, '[a-z0-9]')))::BIGINT AS n_sentences,
        list_filter(coalesce(ids, []), lambda x: x <> '?') AS ids,
        array_to_string(list_transform(coalesce(ids, []), lambda x: '<' || x || '>'), '') AS left_, 0 AS n, []::VARCHAR[] AS names
      FROM s LEFT JOIN f USING (rid)),
{', '.join(steps)}
SELECT doc_id, n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, n::BIGINT AS n_rules,
  coalesce(array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ','), '') AS licenses
FROM {before}
"""


SQL = _sql()
