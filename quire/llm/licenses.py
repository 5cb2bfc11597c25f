"""License scans by sentence rules.

A text is cut into sentences, each is normalised and mapped to the identifier of a known licence
sentence, and the sequence of identifiers is matched against ordered licence rules: a rule is met where
its sentences occur in its order, others between them or not. Two views of a text are
matched: its lines, and the lines of its paragraphs joined (wrapped licence texts). A period after an abbreviation ends no sentence, what a
notice adds after its licence ("the License") does not hide it, and an SPDX expression gives a notice for each of its licences. Everything
is one projection of SQL functions, without a shuffle. The DuckDB oracle has the older cutter, a narrower filter (MARKS) and the
tables SENTENCES, RULES and LEADS alone; tests hold the operator against a plain version as well.

Defined results: a null, empty or licence-free text has no sentences and no licences; licences are
returned once each, in the order of their names; repeated rows and repeated sentences change nothing
but their own rows and counts; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names under which notices cite a licence, normalised (lower case, runs of other characters one space).
NAMES = {
    "Apache-2.0": ["the apache license version 2.0", "apache license 2.0", "the apache license 2.0", "apache 2.0"],
    "BSD-2-Clause": ["the bsd 2 clause license", "the simplified bsd license"],
    "BSD-3-Clause": ["the bsd 3 clause license", "the new bsd license", "the modified bsd license"],
    "CC-BY-4.0": ["cc by 4.0", "a creative commons attribution 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4.0", "a creative commons attribution noncommercial 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4.0", "a creative commons attribution noncommercial sharealike 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4.0", "a creative commons attribution noderivatives 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4.0", "a creative commons attribution sharealike 4.0 international license"],
    "CC0-1.0": ["cc0", "cc0 1.0", "the cc0 1.0 universal public domain dedication"],
    "GPL-2.0": ["the gnu general public license version 2", "gpl v2", "gplv2", "the gpl version 2"],
    "GPL-3.0": ["the gnu general public license version 3", "gpl v3", "gplv3", "the gpl version 3"],
    "AGPL-3.0": ["the gnu affero general public license version 3", "agplv3"],
    "LGPL-2.1": ["the gnu lesser general public license version 2.1", "lgplv2.1"],
    "LGPL-3.0": ["the gnu lesser general public license version 3", "lgplv3"],
    "ISC": ["the isc license"],
    "MIT": ["the mit license", "mit license", "mit"],
    "MPL-2.0": ["the mozilla public license version 2.0", "mpl 2.0", "the mpl 2.0"],
    "Unlicense": ["the unlicense"],
}
# How notices begin.
LEADS = ["licensed under", "released under", "distributed under", "available under", "this work is licensed under", "this file is licensed under", "this software is licensed under", "this project is licensed under", "this code is licensed under", "this work is released under", "this software is released under"]
#: The other beginnings that BEGINS cuts; the DuckDB oracle is held without them.
MORE_LEADS = ["this file is released under", "this project is released under", "this code is released under"]
# Sentences of licence texts, normalised, and their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "mpl-form",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
}
# Ordered rules over the sentences above.
RULES = {
    "MIT": [["mit-grant", "mit-notice"]],
    "ISC": [["isc-grant"]],
    "BSD-3-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]],
    "BSD-2-Clause": [["bsd-grant", "bsd-source", "bsd-binary"]],
    "Apache-2.0": [["apache-compliance", "apache-copy"]],
    "GPL-3.0-or-later": [["gpl3-later"]],
    "GPL-2.0-or-later": [["gpl2-later"]],
    "MPL-2.0": [["mpl-form"]],
    "Unlicense": [["unlicense-grant"]],
}
# More sentences of licence texts and their notices; the DuckDB oracle is held without them.
MORE_SENTENCES = {
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl-form",
    "you may obtain a copy of the license at": "copy-at",
    "http www.apache.org licenses license 2.0": "apache-address",
    "https www.apache.org licenses license 2.0": "apache-address",
    "you may obtain a copy of the license at https www.apache.org licenses license 2.0": "apache-copy",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-only",
    "it under the terms of the gnu general public license version 2 only as published by the free software foundation": "gpl2-only",
    "either version 2 of the license or at your option any later version": "either-2",
    "either version 2.1 of the license or at your option any later version": "either-2.1",
    "either version 3 of the license or at your option any later version": "either-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-free",
}
# Sentences that name a holder, as patterns over the normalised sentence.
TEMPLATES = {"^neither the name of .{1,160} nor the names of (?:its|the) contributors may be used to endorse or promote products derived from this software without specific prior written permission$": "bsd-endorse"}
MORE_RULES = {
    "Apache-2.0": [["apache-compliance", "copy-at", "apache-address"]],
    "GPL-2.0-only": [["gpl2-only"]],
    "GPL-2.0-or-later": [["gpl-terms", "either-2"]],
    "GPL-3.0-or-later": [["gpl-terms", "either-3"]],
    "LGPL-2.1-or-later": [["lgpl-terms", "either-2.1"]],
    "LGPL-3.0-or-later": [["lgpl3-later"], ["lgpl-terms", "either-3"]],
    "AGPL-3.0-or-later": [["agpl3-later"]],
}
# Abbreviations whose period ends no sentence, and what notices add after the licence's name.
ABBREVIATIONS = "v|ver|vs|no|inc|ltd|corp|co|e[.]g|i[.]e|cf|resp"
TAIL = "^((?:this [a-z]+ is )?(?:licensed|released|distributed|available) under .+?) (?:the license|the license agreement|see license(?: file)?|as follows)$"
#: An SPDX expression after its tag.
SPDX = r"(?i)spdx-license-identifier:?[ \t]*(\(*[A-Za-z0-9.+-]+\)*(?:[ \t]+(?:OR|AND|WITH)[ \t]+\(*[A-Za-z0-9.+-]+\)*)*)"
#: A licence whose rule is met as well is not named when the stronger one is.
IMPLIED = {"BSD-2-Clause": "BSD-3-Clause"}
#: The DuckDB oracle's filter; it passes over sentences of other words. The scan takes marks().
MARKS = "(?i)licen[cs]|copyright|spdx|permission|redistribut|unencumbered|free software"
BEGINS = "(?i)((?:this (?:work|file|software|project|code) is (?:licensed|released))|(?:(?:licensed|released|distributed|available) under)|spdx-license-identifier)"


def known_sentences(leads: list[str]) -> dict[str, str]:
    """Every normalised sentence and its identifier; a notice's is its licence's."""
    out = dict(SENTENCES)
    for licence, names in NAMES.items():
        for name in names:
            out |= {f"{lead} {name}": f"notice:{licence}" for lead in leads}
        out[f"spdx license identifier {licence.lower().replace('-', ' ')}"] = f"notice:{licence}"
    return out


def all_sentences() -> dict[str, str]:
    return known_sentences(LEADS + MORE_LEADS) | MORE_SENTENCES


def marks() -> list[str]:
    """A few words of which every known sentence holds one: as a separator ends a word, a text without any of them has no sentence."""
    left, out = [set(s.split()) for s in [*all_sentences(), *(re.sub("[^a-z ]", " ", t) for t in TEMPLATES)]], []
    while left:
        counts = Counter(w for s in left for w in s if len(w) >= 6 or w == "spdx")
        out.append(max(counts, key=lambda w: (counts[w], len(w), w)))
        left = [s for s in left if out[-1] not in s]
    return out


def _rules(more: bool = False) -> list[tuple[str, list[str]]]:
    found = [(licence, [f"notice:{licence}"]) for licence in NAMES]
    tables = (RULES, MORE_RULES) if more else (RULES,)
    return sorted(found + [(licence, rule) for table in tables for licence, rules in table.items() for rule in rules])


def ids_sql(text: str, view: str, duck: bool = False) -> str:
    """An array of the identifiers of a text's known sentences, in order. view: lines or joined."""
    q = lambda s: "'" + (s if duck else s.replace("\\", "\\\\")).replace("'", "''" if duck else "\\'") + "'"
    g = ", 'g'" if duck else ""
    one = "\\1" if duck else "$1"
    line = q("\n") if not duck else "chr(10)"
    text = f"coalesce({text}, '')"
    if view == "joined":
        paragraphs = f"regexp_replace({text}, {q('\\n[ \\t\\r]*\\n[ \\t\\r\\n]*')}, chr(1){g})"
        text = f"replace(regexp_replace({paragraphs}, {q('[ \\t]*\\r?\\n[ \\t*#/]*')}, ' '{g}), chr(1), chr(10))"
    stop = "([.!?;])[ \\t]" if duck else f"(?i)(?<!\\b(?:{ABBREVIATIONS}))([.!?;])[ \\t]"
    cut = f"regexp_replace(regexp_replace({text}, {q(stop)}, concat({q(one)}, {line}){g}), {q(BEGINS)}, concat({line}, {q(one)}){g})"
    normal = lambda s: f"trim(regexp_replace(regexp_replace(lower({s}), {q('[^a-z0-9.+]+')}, ' '{g}), {q('[. ]+$|^[. ]+')}, ''{g}))"
    if duck:
        table = known_sentences(LEADS)
        pieces = f"string_split({cut}, chr(10))"
        keys, values = ", ".join(q(k) for k in table), ", ".join(q(v) for v in table.values())
        return f"list_filter(list_transform({pieces}, lambda s: map([{keys}], [{values}])[{normal('s')}]), lambda s: s IS NOT NULL)"
    pairs = ", ".join(f"{q(k)}, {q(v)}" for k, v in all_sentences().items())
    shapes = " ".join(f"WHEN n RLIKE {q(p)} THEN {q(i)}" for p, i in TEMPLATES.items())
    known = f"coalesce(try_element_at(map({pairs}), regexp_replace(n, {q(TAIL)}, '$1')), CASE {shapes} END)"
    canonical = ", ".join(f"{q(k.lower())}, {q(k)}" for k in sorted({*NAMES, *RULES, *MORE_RULES}))
    tokens = f"regexp_extract_all(regexp_replace(regexp_extract(s, {q(SPDX)}, 1), {q(r'(?i)[ \t]with[ \t]+[A-Za-z0-9.+-]+')}, ''), {q('[A-Za-z0-9][A-Za-z0-9.+-]*')}, 0)"
    names = f"transform(filter({tokens}, t -> lower(t) NOT IN ('or', 'and', 'with')), t -> regexp_replace(t, {q('[.]+$')}, ''))"
    spdx = f"transform({names}, t -> concat('notice:', coalesce(try_element_at(map({canonical}), lower(t)), t)))"
    one = f"CASE WHEN s RLIKE {q(SPDX)} THEN {spdx} ELSE transform(array({normal('s')}), n -> {known}) END"
    return f"filter(flatten(transform(split({cut}, {q('\n')}), s -> {one})), i -> i IS NOT NULL)"


def licences_sql(lines: str, joined: str, duck: bool = False) -> str:
    """An array of the licences whose rules are met in either sequence, in the order of their names."""
    array = "[{}]" if duck else "array({})"
    joiner = "list_aggregate({}, 'string_agg', ',')" if duck else "array_join({}, ',')"
    met: dict[str, list[str]] = {}
    for licence, rule in _rules(not duck):
        like = "'%," + ",%,".join(rule) + ",%'"
        for ids in (lines, joined):
            text = f"replace(concat(',', coalesce({joiner.format(ids)}, ''), ','), ',', ',,')"
            met.setdefault(licence, []).append(f"{text} LIKE {like}")
    whole = {k: "(" + " OR ".join(v) + ")" for k, v in met.items()}
    for weak, strong in IMPLIED.items():
        whole[weak] = f"({whole[weak]} AND NOT {whole[strong]})"
    cases = ", ".join(f"CASE WHEN {whole[k]} THEN '{k}' END" for k in sorted(whole))
    if duck:
        return f"list_filter({array.format(cases)}, lambda s: s IS NOT NULL)"
    notices = " , ".join(f"transform(filter({ids}, i -> i LIKE 'notice:%'), i -> substring(i, 8))" for ids in (lines, joined))
    return f"array_sort(array_distinct(concat(filter({array.format(cases)}, s -> s IS NOT NULL), {notices})))"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Id, ``keep`` columns, sentence_ids (lines), joined_ids (lines joined) and licenses, all arrays, of every whole text."""
    keep = [c for c in keep or [] if c not in (id_col, text_col)]
    text = F.when(F.lower(text_col).rlike("|".join(marks())), F.col(text_col)).alias("_quire_text")
    marked = docs.select(id_col, text, *keep)
    found = marked.select(id_col, *keep, *[F.when(F.col("_quire_text").isNotNull(), F.expr(ids_sql("_quire_text", view))).otherwise(F.expr("cast(array() as array<string>)")).alias(name) for view, name in (("lines", "sentence_ids"), ("joined", "joined_ids"))])
    return found.select(id_col, *keep, "sentence_ids", "joined_ids", F.expr(licences_sql("sentence_ids", "joined_ids")).alias("licenses"))
