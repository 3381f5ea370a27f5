"""Licence scans by sentence rules, in DataFrame functions only.

Comment marks at the starts of lines go, a blank line or a full stop, exclamation or question mark before white space ends a sentence, and a single
line end is a soft break within it. Sentences are normalised (lower case, letters and digits, single spaces). A sentence is known if
the lines from one of its soft breaks to another one, joined, are in the table of known licence sentences: so wrapped notices are found
as well as one-line ones between lines without a full stop. Only lines that start like a known sentence are joined, at most ``LINES`` of
them, more than the longest known sentence takes when it is wrapped.

What is left of a document is its sequence of sentence ids, and ordered rules are matched against that: a rule holds if its ids occur in
order, whatever stands between them. Everything happens within the row, so there is no shuffle and a hot document costs no more
than its length.

The table holds the sentences of notices as written, and references (``licensed under the ...``) made from licence names and phrasings.
Both can be replaced by a caller's. Null and empty texts have no sentences, no ids and no licences; repeated rows give equal results; other
columns are ignored by ``report`` and kept by ``with_licences``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Normalised sentences of licence notices and their ids.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_disclaimer",
    "licensed under the apache license version 2 0 the license": "apache_head",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache_notice",
    "you may not use this file except in compliance with the license": "apache_use",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache_basis",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_hope",
    "you should have received a copy of the gnu general public license along with this program": "gpl_copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3_grant",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl_copy",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21_grant",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl_hope",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl_form",
    "this source code form is subject to the terms of the mozilla public license v": "mpl_form",  # as the stop cuts it
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl_copy",
    "this is free and unencumbered software released into the public domain": "unlicense_free",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense_anyone",
    "this software is provided as is without any express or implied warranty": "zlib_as_is",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law": "cc0_deed",
}

#: Licences with the prefix of their ids and the names that references use, normalised.
NAMES = {
    "MIT": ("mit", ["mit license", "mit licence"]),
    "Apache-2.0": ("apache", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache license v2 0"]),
    "GPL-3.0": ("gpl3", ["gnu general public license version 3", "gnu general public license v3 0", "gnu gpl v3", "gpl v3", "gplv3"]),
    "GPL-2.0": ("gpl2", ["gnu general public license version 2", "gnu general public license v2 0", "gnu gpl v2", "gpl v2", "gplv2"]),
    "LGPL-2.1": ("lgpl21", ["gnu lesser general public license version 2 1", "lgpl v2 1"]),
    "LGPL-3.0": ("lgpl3", ["gnu lesser general public license version 3", "lgpl v3"]),
    "AGPL-3.0": ("agpl3", ["gnu affero general public license version 3", "agpl v3", "agplv3"]),
    "BSD-3-Clause": ("bsd3", ["bsd 3 clause license", "3 clause bsd license", "new bsd license"]),
    "BSD-2-Clause": ("bsd2", ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license"]),
    "ISC": ("isc", ["isc license"]),
    "MPL-2.0": ("mpl", ["mozilla public license 2 0", "mozilla public license version 2 0"]),
    "EPL-2.0": ("epl", ["eclipse public license 2 0", "eclipse public license version 2 0"]),
    "BSL-1.0": ("bsl", ["boost software license version 1 0"]),
    "Unlicense": ("unlicense", ["unlicense"]),
    "Zlib": ("zlib", ["zlib license"]),
    "CC0-1.0": ("cc0", ["cc0 1 0 universal", "cc0 1 0"]),
    "CC-BY-4.0": ("ccby", ["cc by 4 0", "creative commons attribution 4 0 international license"]),
    "CC-BY-SA-4.0": ("ccbysa", ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"]),
    "CC-BY-NC-4.0": ("ccbync", ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"]),
    "CC-BY-ND-4.0": ("ccbynd", ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"]),
}

#: How a reference begins.
PHRASES = [f"{who}{verb} under {the}" for who in ("", "this work is ", "this project is ", "this software is ", "this code is ", "this package is ", "this file is ")
           for verb in ("licensed", "released", "distributed") for the in ("", "the ", "a ")]

#: Licences with a rule of their own beside references and tags.
TEXTS = {
    "mit_text": ("MIT", ("mit_grant", "mit_notice", "mit_disclaimer")),
    "mit_titled": ("MIT", ("mit_title", "mit_grant")),
    "apache_header": ("Apache-2.0", ("apache_head", "apache_use", "apache_basis")),
    "apache_joined_header": ("Apache-2.0", ("apache_notice", "apache_basis")),
    "gpl3_notice": ("GPL-3.0", ("gpl3_grant", "gpl_hope", "gpl_copy")),
    "gpl2_notice": ("GPL-2.0", ("gpl2_grant", "gpl_hope")),
    "agpl3_notice": ("AGPL-3.0", ("agpl3_grant", "gpl_hope", "agpl_copy")),
    "lgpl21_notice": ("LGPL-2.1", ("lgpl21_grant", "lgpl_hope")),
    "bsd3_text": ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_name")),
    "bsd2_text": ("BSD-2-Clause", ("bsd_grant", "bsd_source")),
    "isc_text": ("ISC", ("isc_grant",)),
    "mpl_header": ("MPL-2.0", ("mpl_form", "mpl_copy")),
    "unlicense_text": ("Unlicense", ("unlicense_free", "unlicense_anyone")),
    "zlib_text": ("Zlib", ("zlib_as_is", "zlib_grant")),
    "cc0_text": ("CC0-1.0", ("cc0_deed",)),
}


def _references() -> dict[str, str]:
    """Sentences that refer to a licence, name it in a title, or tag it."""
    out = {}
    for licence, (prefix, names) in NAMES.items():
        for name in names:
            out |= {name: f"{prefix}_title", f"the {name}": f"{prefix}_title"} | {phrase + name: f"{prefix}_ref" for phrase in PHRASES}
        tag = "spdx license identifier " + licence.lower().replace("-", " ").replace(".", " ")
        out |= {tag: f"{prefix}_spdx", f"{tag} or later": f"{prefix}_spdx", f"{tag} only": f"{prefix}_spdx"}
    return out


SENTENCES = _references() | NOTICES
RULES = {k: TEXTS[k] for k in ("mit_text",)} | {f"{p}_reference": (n, (f"{p}_ref",)) for n, (p, _) in NAMES.items()} \
    | {f"{p}_tag": (n, (f"{p}_spdx",)) for n, (p, _) in NAMES.items()} | TEXTS

LINES = 24
#: The marks of hard and soft breaks.
HARD, SOFT = "\x1e", "\x1f"
COMMENT = r"(^|\n)[ \t]*(?:[#*;%>!|]+|//+|/[*]+|--+|<!--+)[ \t*]*"
BLANK = r"\n[ \t]*(?:\n[ \t]*)+"
ENDS = r"[.!?]+(?:[ \t\n]+|$)"
NOISE = r"[^\p{L}\p{N}\x1e\x1f]+"


def sentences(text: Column) -> Column:
    """Normalised non-empty sentences in order, each as an array of its non-empty lines."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "\r\n?", "\n")
    flat = F.regexp_replace(F.regexp_replace(flat, COMMENT, "$1"), BLANK, HARD)
    flat = F.regexp_replace(F.replace(F.regexp_replace(flat, ENDS, HARD), F.lit("\n"), F.lit(SOFT)), NOISE, " ")
    lines = F.transform(F.split(flat, HARD), lambda s: F.filter(F.transform(F.split(s, SOFT), lambda x: F.trim(x)), lambda x: x != ""))
    return F.filter(lines, lambda s: F.size(s) > 0)


def _start(line):
    """The first two words of a normalised sentence."""
    return " ".join(line.split(" ")[:2]) if isinstance(line, str) else F.substring_index(line, " ", 2)


def known(sentence_array: Column, table: dict[str, str]) -> Column:
    """Ids of the known sentences, in order of their first and then their last line."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    starts = {_start(s) for s in table} | {s.split(" ")[0] for s in table}  # a first line may be one word

    def within(lines: Column) -> Column:
        begin = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: _start(F.get(lines, i - 1)).isin(*starts))
        spans = F.flatten(F.transform(begin, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.size(lines) - i + 1, F.lit(LINES))),
                                                                   lambda n: F.array_join(F.slice(lines, i, n), " "))))
        return F.filter(spans, lambda s: s.isin(*table))
    return F.transform(F.flatten(F.transform(sentence_array, within)), lambda s: F.element_at(pairs, s))


def rule_pattern(ids: tuple[str, ...]) -> str:
    """A pattern over ``;a;;b;`` that finds the ids in order."""
    return "(;[a-z0-9_]+;)*".join(f";{i};" for i in ids)


def with_licences(df: DataFrame, text: str = "text", table: dict[str, str] | None = None,
                  rules: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """``df`` with n_sentences, sentence_ids, rules and licences (arrays, rules in the order given)."""
    table, rules = table or SENTENCES, rules or RULES
    out = df.withColumn("sentence_ids", sentences(F.col(f"`{text}`"))) \
        .withColumn("n_sentences", F.size("sentence_ids").cast("long")) \
        .withColumn("sentence_ids", known(F.col("sentence_ids"), table))
    seq = F.concat_ws("", F.transform("sentence_ids", lambda i: F.concat(F.lit(";"), i, F.lit(";"))))
    met = [F.when(seq.rlike(rule_pattern(ids)), F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence")))
           for name, (licence, ids) in rules.items()]
    out = out.withColumn("rules", F.when(F.size("sentence_ids") > 0, F.array_compact(F.array(*met))).otherwise(
        F.array().cast("array<struct<rule:string,licence:string>>")))
    return out.withColumn("licences", F.array_distinct(F.col("rules.licence"))).withColumn("rules", F.col("rules.rule"))


def report(df: DataFrame) -> DataFrame:
    found = with_licences(df.select("doc_id", "text"))
    return found.select("doc_id", "n_sentences", F.size("sentence_ids").cast("long").alias("n_known"),
                        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
                        F.concat_ws(",", "rules").alias("rules"), F.concat_ws(",", "licences").alias("licences"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def report_sql() -> str:
    """DuckDB SQL for ``report`` over ``documents``."""
    pairs = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in SENTENCES.items())
    met = ", ".join(f"CASE WHEN regexp_matches(seq, {_quoted(rule_pattern(ids))}) THEN {_quoted(name + '|' + lic)} END"
                    for name, (lic, ids) in RULES.items())
    return f"""
WITH known(sentence, id) AS (VALUES {pairs}),
flat AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '\\r\\n?', chr(10), 'g'),
    {_quoted(COMMENT)}, '\\1', 'g'), {_quoted(BLANK)}, chr(30), 'g'), {_quoted(ENDS)}, chr(30), 'g'), chr(10), chr(31)), {_quoted(NOISE)}, ' ', 'g') AS t FROM documents),
cut AS (
  SELECT n, doc_id, list_filter(list_transform(string_split(t, chr(30)), lambda s: list_filter(list_transform(string_split(s, chr(31)), lambda x: trim(x)), lambda x: x <> '')), lambda s: len(s) > 0) AS s FROM flat),
sentences AS (SELECT n, unnest(s) AS lines, generate_subscripts(s, 1) AS place FROM cut),
begins AS (SELECT n, place, lines, unnest(range(1, len(lines) + 1)) AS i FROM sentences),
spans AS (
  SELECT n, place, i, j, array_to_string(lines[i:j], ' ') AS sentence FROM (SELECT *, unnest(range(i, least(len(lines), i + {LINES - 1}) + 1)) AS j FROM begins
    WHERE array_to_string(string_split(lines[i], ' ')[1:2], ' ') IN (SELECT array_to_string(string_split(sentence, ' ')[1:2], ' ') FROM known UNION SELECT string_split(sentence, ' ')[1] FROM known))),
ids AS (SELECT n, list(id ORDER BY place, i, j) AS ids FROM spans JOIN known USING (sentence) GROUP BY n),
seqs AS (SELECT cut.doc_id, len(s) AS n_sentences, coalesce(ids, []) AS ids,
  coalesce(array_to_string(list_transform(ids, lambda i: ';' || i || ';'), ''), '') AS seq FROM cut LEFT JOIN ids USING (n)),
rules AS (SELECT *, list_filter([{met}], lambda x: x IS NOT NULL) AS met FROM seqs),
named AS (SELECT *, list_transform(met, lambda x: split_part(x, '|', 2)) AS lic FROM rules)
SELECT doc_id, n_sentences::BIGINT AS n_sentences, len(ids)::BIGINT AS n_known, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_transform(met, lambda x: split_part(x, '|', 1)), ',') AS rules,
  array_to_string(list_filter(lic, lambda x, i: list_position(lic, x) = i), ',') AS licences
FROM named"""
