"""Licence recognition by sentence rules.

A text is cut into sentences, each sentence is normalised and mapped to the
identifier of a known licence sentence, and the sequence of identifiers is
matched against ordered rules.  What is no known sentence by itself is joined
again, and known sentences are looked for in it as runs of words, so that line
ends, comment markers and punctuation inside a sentence don't matter; those of
WHOLE count only as a sentence of their own.  Longer rules go first and use up the
identifiers they match; identifiers that no rule uses are counted.

Everything happens inside the row with SQL functions: no shuffle, no Python.

Defined cases: null and empty texts have no sentences and no licence; repeated
rows give repeated results; a licence that occurs twice is listed once; other
columns of the input are ignored, whatever they are called.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, by identifier,
# in the normal form that ``normal`` gives (lower case; runs of other
# characters than letters, digits and . + - as one space; no final full stop).
SENTENCES = {
    "APACHE_NAME": "licensed under the apache license version 2.0",
    "APACHE_FULL": "licensed under the apache license version 2.0 the license",
    "APACHE_MAY": "you may not use this file except in compliance with the license",
    "APACHE_COPY": "you may obtain a copy of the license at",
    "APACHE_URL": "http www.apache.org licenses license-2.0",
    "APACHE_ASIS": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHE_SEE": "see the license for the specific language governing permissions and limitations under the license",
    "MIT_NAME": "released under the mit license",
    "MIT_NAME_2": "licensed under the mit license",
    "MIT_TITLE": "the mit license",
    "MIT_TITLE_2": "mit license",
    "MIT_GRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT_NOTICE": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MIT_ASIS": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MIT_LIABLE": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "BSD_GRANT": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD_SOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD_BINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BSD_ENDORSE": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "ISC_GRANT": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "GPL3_NAME": "this work is licensed under the gnu general public license version 3",
    "GPL_REDIST_2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPL_REDIST_3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL_HOPE": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPL_SEE": "see the gnu general public license for more details",
    "LGPL_SEE": "see the gnu lesser general public license for more details",
    "MPL2_TERMS": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "CC_BY_NAME": "licensed under cc by 4.0",
    "CC_BYSA_NAME": "licensed under cc by-sa 4.0",
    "CC_BYNC_NAME": "licensed under cc by-nc 4.0",
    "CC_BY_LONG": "this work is licensed under a creative commons attribution 4.0 international license",
    "CC_BYSA_LONG": "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    "CC_BYNC_LONG": "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
    "CC0_LONG": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "UNLICENSE": "this is free and unencumbered software released into the public domain",
    "ALL_RIGHTS": "all rights reserved",
}

# Licence name and the sentence identifiers it asks for, in order.
RULES = (
    ("Apache-2.0", ("APACHE_FULL", "APACHE_MAY", "APACHE_COPY", "APACHE_URL", "APACHE_ASIS", "APACHE_SEE")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ENDORSE")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "MIT_ASIS", "MIT_LIABLE")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("GPL-2.0-or-later", ("GPL_REDIST_2", "GPL_HOPE", "GPL_SEE")),
    ("GPL-3.0-or-later", ("GPL_REDIST_3", "GPL_HOPE", "GPL_SEE")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("MIT", ("MIT_TITLE", "MIT_GRANT")),
    ("GPL-2.0-or-later", ("GPL_REDIST_2",)),
    ("GPL-3.0-or-later", ("GPL_REDIST_3",)),
    ("Apache-2.0", ("APACHE_NAME",)),
    ("Apache-2.0", ("APACHE_FULL",)),
    ("MIT", ("MIT_NAME",)),
    ("MIT", ("MIT_NAME_2",)),
    ("MIT", ("MIT_TITLE",)),
    ("MIT", ("MIT_TITLE_2",)),
    ("ISC", ("ISC_GRANT",)),
    ("GPL-3.0-only", ("GPL3_NAME",)),
    ("MPL-2.0", ("MPL2_TERMS",)),
    ("CC-BY-4.0", ("CC_BY_NAME",)),
    ("CC-BY-4.0", ("CC_BY_LONG",)),
    ("CC-BY-SA-4.0", ("CC_BYSA_NAME",)),
    ("CC-BY-SA-4.0", ("CC_BYSA_LONG",)),
    ("CC-BY-NC-4.0", ("CC_BYNC_NAME",)),
    ("CC-BY-NC-4.0", ("CC_BYNC_LONG",)),
    ("CC0-1.0", ("CC0_LONG",)),
    ("Unlicense", ("UNLICENSE",)),
    ("Proprietary", ("ALL_RIGHTS",)),
)

# More notices; the tables above are those of the SQL.  A name in its usual forms gives (identifier, rule).
_NAMED = {
    "Apache-2.0": ("apache license 2.0", "apache 2.0 license", "apache-2.0 license", "apache license v2.0"),
    "BSD": ("bsd license",),
    "BSD-2-Clause": ("bsd 2-clause license", "bsd-2-clause license", "2-clause bsd license", "simplified bsd license", "bsd 2-clause simplified license"),
    "BSD-3-Clause": ("bsd 3-clause license", "bsd-3-clause license", "3-clause bsd license", "new bsd license", "modified bsd license", "bsd 3-clause new or revised license"),
    "ISC": ("isc license",),
    "MPL-2.0": ("mozilla public license version 2.0", "mozilla public license v2.0", "mozilla public license 2.0", "mpl 2.0", "mpl-2.0"),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0 1.0", "cc0 1.0 universal"),
}
for _short, _long, _versions in (("gpl", "gnu general public license", ("2", "3")), ("lgpl", "gnu lesser general public license", ("2.1", "3")), ("agpl", "gnu affero general public license", ("3",))):
    for _v in _versions:
        _name = f"{_short.upper()}-{_v if '.' in _v else _v + '.0'}"
        _forms = [f"{stem} {x}" for stem in (_long, _long[4:], f"gnu {_short}", _short) for n in {_v, _v if "." in _v else _v + ".0"} for x in (f"version {n}", f"v{n}", n)]
        _forms += [f"{_short}v{_v}", f"gnu {_short}v{_v}"]
        _NAMED[f"{_name}-only"] = (*_forms, *(f"{x} only" for x in _forms))
        _NAMED[f"{_name}-or-later"] = (*(f"{x} {y}" for x in _forms for y in ("or later", "or any later version", "or at your option any later version")), f"{_short}v{_v}+", f"gnu {_short}v{_v}+")

_REDIST = "this {} is free software you can redistribute it and or modify it under the terms of the gnu {} general public license as published by the free software foundation either version {} of the license or at your option any later version"
_HOPE = "this {} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
MORE_SENTENCES = {
    "LGPL21_REDIST": (_REDIST.format("library", "lesser", "2.1"), _REDIST.format("program", "lesser", "2.1")),
    "LGPL3_REDIST": (_REDIST.format("library", "lesser", "3"), _REDIST.format("program", "lesser", "3")),
    "AGPL3_REDIST": (_REDIST.format("program", "affero", "3"),),
    "LGPL_HOPE": (_HOPE.format("library"),),
    "AGPL_SEE": ("see the gnu affero general public license for more details",),
    "APACHE_URL": ("https www.apache.org licenses license-2.0",),
}
MORE_RULES = []
for _name, _id, _hopes, _see in (("LGPL-2.1-or-later", "LGPL21_REDIST", ("LGPL_HOPE", "GPL_HOPE"), "LGPL_SEE"), ("LGPL-3.0-or-later", "LGPL3_REDIST", ("LGPL_HOPE", "GPL_HOPE"), "LGPL_SEE"), ("AGPL-3.0-or-later", "AGPL3_REDIST", ("GPL_HOPE",), "AGPL_SEE")):
    MORE_RULES += [*((_name, (_id, x, _see)) for x in _hopes), (_name, (_id,))]
for _name in dict.fromkeys((*_NAMED, *(name for name, _ in RULES), *(name for name, _ in MORE_RULES))):
    if _name not in ("Proprietary", "BSD"):
        MORE_SENTENCES[f"SPDX {_name}"] = (f"spdx-license-identifier {_name.lower()}",)
        MORE_RULES.append((_name, (f"SPDX {_name}",)))
    if _name in _NAMED:
        _lead = [f"{verb} under {the}" for verb in ("licensed", "released", "distributed") for the in ("the ", "")]
        _own = [lead + x for lead in _lead for x in _NAMED[_name]]
        MORE_SENTENCES[f"NAME {_name}"] = tuple(dict.fromkeys(x for x in _own if x not in SENTENCES.values()))
        MORE_RULES.append((_name, (f"NAME {_name}",)))
MORE_RULES = tuple(MORE_RULES)


def everything() -> list:
    """(sentence, identifier) of both tables."""
    return [(x, name) for name, x in SENTENCES.items()] + [(x, name) for name, forms in MORE_SENTENCES.items() for x in forms]


#: Short sentences that would say too little inside a longer one.
WHOLE = ("MIT_TITLE", "MIT_TITLE_2", "ALL_RIGHTS")

#: What ends a sentence: a line end, or . ! or ? before white space.
_END, _OTHER = "([.!?])[ \\t\\r\\n]+", "[^\\p{L}\\p{N}.+-]+"


def normal(sentence):
    """A sentence in the form of SENTENCES (column to column)."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(sentence), _OTHER, " ")), "[. ]+$", "")


def sentences(text):
    """The normalised sentences of a text, in order, without empty ones."""
    cut = F.split(F.regexp_replace(text, _END, "$1\n"), "[\r\n]+")
    return F.filter(F.transform(cut, normal), lambda s: s != "")


def words(sentence: str) -> str:
    """A table sentence as it stands in a joined text: no stop at the end of a word, no words without letters or digits."""
    return re.sub(r" [.+-]+(?= )", "", re.sub(r"\.+(?= |$)", "", f" {sentence} ")).strip()


def _runs(sentences) -> str:
    """A pattern of runs of words, the longest that fits first; common beginnings are tried once."""
    root: dict = {}
    for sentence in sorted(sentences):
        at = root
        for word in sentence.split(" "):
            at = at.setdefault(word, {})
        at[""] = {}

    def pattern(node, before):
        ways = [before + re.escape(word) + pattern(below, " ") for word, below in node.items() if word]
        ways += ["(?= )"] if "" in node else []
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return pattern(root, "")


def _found(s, table: list):
    """Normalised sentences (column) to the identifiers of the known ones, in order."""
    known = F.create_map(*[F.lit(x) for pair in table for x in pair])
    inside = {words(sentence): name for sentence, name in table if name not in WHOLE}
    by_words = F.create_map(*[F.lit(x) for pair in inside.items() for x in pair])
    # Known sentences stand between < and >, which no normalised sentence holds.
    joined = F.concat(F.lit(" "), F.array_join(F.transform(s, lambda x: F.coalesce(F.concat(F.lit("<"), F.try_element_at(known, x), F.lit(">")), x)), " "), F.lit(" "))
    joined = F.regexp_replace(F.regexp_replace(joined, "\\.+(?= )", ""), " [.+-]+(?= )", "")
    each = F.regexp_extract_all(joined, F.lit(f"(?<= )(?:<[^>]+>|{_runs(inside)})"), F.lit(0))
    return F.transform(each, lambda x: F.when(x.startswith("<"), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(F.try_element_at(by_words, x)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table=None, rules=None) -> DataFrame:
    """One row for each row of docs: id, n_sentences, sentence_ids, licenses, n_unused.

    sentence_ids: recognised identifiers in order; licenses: names in the order
    of the rules, each once; both joined by commas.
    """
    table = everything() if table is None else [(sentence, name) for name, sentence in table.items()]
    rules = (*RULES, *MORE_RULES) if rules is None else rules
    found = docs.select(F.col(id_col).alias("id"), sentences(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("s"))
    found = found.select("id", F.size("s").cast("long").alias("n"), _found(F.col("s"), table).alias("ids"))
    # Each identifier between its own commas, so that a used run can be taken out without joining its neighbours.
    found = found.withColumn("rest0", F.concat_ws("", F.transform("ids", lambda x: F.concat(F.lit("<"), x, F.lit(">")))))
    hits, ordered = [], sorted(rules, key=lambda r: -len(r[1]))
    for k, (name, wanted) in enumerate(ordered):
        run = F.lit("".join(f"<{x}>" for x in wanted))
        hits.append(F.when(F.contains(F.col(f"rest{k}"), run), F.lit(name)))
        found = found.withColumn(f"rest{k + 1}", F.when(F.col(f"rest{k}") == "", F.lit("")).otherwise(F.replace(F.col(f"rest{k}"), run, F.lit("|"))))
    left = F.col(f"rest{len(ordered)}")
    names = F.array_distinct(F.array_compact(F.array(*hits)))
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(names, ",").alias("licenses"),
        (F.length(left) - F.length(F.replace(left, F.lit("<"), F.lit("")))).cast("long").alias("n_unused"),
    )


def oracle(table="documents") -> str:
    """The same in DuckDB for texts whose known sentences stand one to a line or stop."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(n)})" for n, s in SENTENCES.items())
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    runs = ["".join(f"<{x}>" for x in wanted) for _, wanted in ordered]
    steps = [f"r0 AS (SELECT *, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS rest FROM h)"]
    for k, run in enumerate(runs):
        steps.append(f"r{k + 1} AS (SELECT * REPLACE (replace(rest, '{run}', '|') AS rest), contains(rest, '{run}') AS m{k} FROM r{k})")
    names: dict[str, list[str]] = {}
    for k, (name, _) in enumerate(ordered):
        names.setdefault(name, []).append(f"m{k}")
    listed = ", ".join(f"CASE WHEN {' OR '.join(ms)} THEN '{n}' END" for n, ms in names.items())
    other = "[^\\p{L}\\p{N}.+-]+"
    return f"""
WITH known(s, name) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
   list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), '[\\r\\n]+'),
     lambda s: regexp_replace(trim(regexp_replace(lower(s), '{other}', ' ', 'g')), '[. ]+$', '')), lambda s: s <> '') AS ss FROM {table}),
e AS (SELECT rid, unnest(ss) AS s, unnest(range(len(ss))) AS k FROM d),
g AS (SELECT e.rid, list(known.name ORDER BY e.k) AS ids FROM e JOIN known USING (s) GROUP BY e.rid),
h AS (SELECT d.doc_id, len(d.ss) AS n, coalesce(g.ids, []::VARCHAR[]) AS ids FROM d LEFT JOIN g USING (rid)),
{", ".join(steps)}
SELECT doc_id, n::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ',') AS licenses,
  (length(rest) - length(replace(rest, '<', '')))::BIGINT AS n_unused
FROM r{len(runs)}"""
