"""Licence recognition by sentence identifiers and ordered rules, in Spark expressions only.

Licence texts are wrapped and stand in comments, so marks before a line's first letter or digit are taken off, and a text is cut at
blank lines and after full stops, semicolons and colons that white space follows. A known sentence may run over single line feeds,
and may begin or end at one. A sentence is folded to lower-case letters and digits with single blanks between; ``<name>`` in a
known one stands for any number of words. Known sentences map to an identifier;
the identifiers of a text, in order, form a sequence in which each licence's rule must occur as a run. A rule contained
in a longer one at the same place does not fire there on its own.

Everything happens within a row: no shuffle. Only texts with one of the key words of the known sentences are cut; that every
known sentence has one is checked when the rules are compiled, so nothing is lost. Null, empty and text without known
sentences: no licence. Extra columns are ignored; repeated rows are recognised alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentence ends, and line feeds within or between sentences, in a folded text.
END, LINE = "\x01", "\x02"
KEY_WORDS = ("licen", "copyright", "permission", "warrant", "redistribut", "public domain")


@dataclass(frozen=True)
class Rule:
    """A licence and the sentences that must follow one another for it."""

    license: str
    sentences: tuple[str, ...]


BSD = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
)
NO_ENDORSEMENT = "Neither the name of <name> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
ISC_GRANT = "Permission to use, copy, modify, {} distribute this software for any purpose with or without fee is hereby granted"
FSF_GRANT = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"

#: Public licence notices, as published with the licences.
RULES = (
    Rule("Apache-2.0", ("Licensed under the Apache License, Version 2.0.",)),
    Rule("Apache-2.0", ("Licensed under the Apache License, Version 2.0 (the \"License\");",)),
    Rule("Apache-2.0", (
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at",
    )),
    Rule("MIT", ("Released under the MIT License.",)),
    Rule("MIT", ("Licensed under the MIT License.",)),
    Rule("MIT", (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    )),
    Rule("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3.",)),
    Rule("GPL-3.0-or-later", (
        "This program is free software:",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    )),
    Rule("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0.",)),
    Rule("CC-BY-4.0", ("Licensed under CC BY 4.0.",)),
    Rule("CC-BY-SA-4.0", ("Licensed under CC BY-SA 4.0.",)),
    Rule("BSD-2-Clause", BSD),
    Rule("BSD-3-Clause", (*BSD, NO_ENDORSEMENT)),
    Rule("BSD-3-Clause", (*BSD, NO_ENDORSEMENT.replace("names of its contributors", "names of contributors"))),
    Rule("BSD-4-Clause", (*BSD, "All advertising materials mentioning features or use of this software must display the following acknowledgement:", NO_ENDORSEMENT)),
    Rule("MIT", (MIT_GRANT + ", subject to the following conditions:",)),
    Rule("MIT", (
        MIT_GRANT + ", subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    )),
    Rule("MIT-0", (MIT_GRANT + ".",)),
    Rule("ISC", (ISC_GRANT.format("and/or") + ", provided that the above copyright notice and this permission notice appear in all copies.",)),
    Rule("ISC", (ISC_GRANT.format("and") + ", provided that the above copyright notice and this permission notice appear in all copies.",)),
    Rule("0BSD", (ISC_GRANT.format("and/or") + ".",)),
    Rule("GPL-2.0-or-later", (FSF_GRANT.format("General Public License") + ";", "either version 2 of the License, or (at your option) any later version.")),
    Rule("GPL-2.0", (FSF_GRANT.format("General Public License version 2") + ".",)),
    Rule("GPL-3.0-or-later", (FSF_GRANT.format("General Public License") + ", either version 3 of the License, or (at your option) any later version.",)),
    Rule("LGPL-2.1-or-later", (FSF_GRANT.format("Lesser General Public License") + ";", "either version 2.1 of the License, or (at your option) any later version.")),
    Rule("LGPL-3.0-or-later", (FSF_GRANT.format("Lesser General Public License") + ", either version 3 of the License, or (at your option) any later version.",)),
    Rule("AGPL-3.0-or-later", (FSF_GRANT.format("Affero General Public License") + ", either version 3 of the License, or (at your option) any later version.",)),
    Rule("GPL-2.0", ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",)),
    Rule("GPL-3.0", ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",)),
    Rule("LGPL-2.1", ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",)),
    Rule("LGPL-3.0", ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",)),
    Rule("AGPL-3.0", ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",)),
    Rule("Apache-2.0", ("Apache License Version 2.0, January 2004",)),
    Rule("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v.", "2.0.")),
    Rule("MPL-2.0", ("Mozilla Public License Version 2.0",)),
    Rule("Unlicense", ("This is free and unencumbered software released into the public domain.",)),
)


def normal(sentence: str) -> str:
    """The folded form of a known sentence, as ``folded_column`` makes it of a text's; ``<name>`` stays."""
    parts = sentence.translate({c: c + 32 for c in range(65, 91)}).split("<name>")
    return " <name> ".join(re.sub(r"[^a-z0-9]+", " ", x).strip(" ") for x in parts)


def folded_column(text: str) -> Column:
    """The text's words with single blanks, END or LINE between, and END around."""
    x = F.translate(text, f"ABCDEFGHIJKLMNOPQRSTUVWXYZ{END}{LINE}", "abcdefghijklmnopqrstuvwxyz  ")
    x = F.regexp_replace(x, r"(?md)^[^a-z0-9\n]+", "")  # comment marks, bullets, indents
    x = F.regexp_replace(x, r"(?md)^(?:[0-9]{1,2}|[a-z])[.)](?=\s)|[.;:](?=\s)|\n{2,}", END)
    x = F.regexp_replace(F.translate(x, "\n", LINE), f"[^a-z0-9{END}{LINE}]+", " ")
    return F.concat(F.lit(END), F.regexp_replace(x, f" ?([{END}{LINE}]) ?", "$1"), F.lit(END))


def sentence_pattern(sentence: str) -> str:
    """A regular expression of a folded sentence, which may be wrapped."""
    between = f"[ {LINE}]"
    return between.join(f"[a-z0-9][a-z0-9 {LINE}]*?" if w == "<name>" else w for w in sentence.split(" "))


def compiled(rules: tuple[Rule, ...]) -> tuple[dict[str, int], list[tuple[str, tuple[int, ...]]]]:
    """Identifiers of known sentences, and each rule as a run of them, longest first."""
    ids: dict[str, int] = {}
    runs = []
    for rule in rules:
        run = tuple(ids.setdefault(normal(s), len(ids) + 1) for s in rule.sentences)
        if not run or "" in map(normal, rule.sentences):
            raise ValueError(f"{rule.license} has an empty sentence")
        runs.append((rule.license, run))
    if any(not any(k in s for k in KEY_WORDS) for run in runs for s in [" ".join(s for s, i in ids.items() if i in run[1])]):
        raise ValueError("a rule has none of the key words")
    return ids, sorted(runs, key=lambda x: (-len(x[1]), x))


def license_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: ``doc_id``, ``sentence_ids`` (known ones in order, comma-joined) and ``licenses`` (distinct, sorted, comma-joined)."""
    ids, runs = compiled(rules)
    whole = [x for x in ids.items() if "<name>" not in x[0]]
    known = F.create_map(*[F.lit(x) for pair in whole for x in pair]) if whole else F.lit(None).cast("map<string,int>")
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    worth = F.col("text").isNotNull()
    word = F.lit(False)
    for k in KEY_WORDS:
        word = word | F.contains(folded, F.lit(k))
    # at one place the longest of the sentences that fit
    any_of = "|".join(sentence_pattern(s) for s in sorted(ids, key=lambda s: (-len(s), s)))
    matched = F.regexp_extract_all(folded_column("text"), F.lit(f"[{END}{LINE}]({any_of})(?= ?[{END}{LINE}])"), F.lit(1))

    def id_of(s: Column) -> Column:
        s = F.translate(s, LINE, " ")
        return F.coalesce(known[s], *[F.when(F.rlike(s, F.lit(f"^{sentence_pattern(x)}$")), i) for x, i in ids.items() if "<name>" in x])

    found = F.transform(matched, id_of)
    marks = F.when(worth & word, F.array_join(F.transform(found, lambda i: F.format_string("<%d>", i)), "")).otherwise("")
    out = docs.select("doc_id", marks.alias("_marks"))
    # the longest rules first; what they match is taken out, with a stop in its place
    rest, hits = F.col("_marks"), []
    for name, run in runs:
        text = F.lit("".join(f"<{i}>" for i in run))
        hits.append(F.when(F.contains(rest, text), F.lit(name)))
        rest = F.replace(rest, text, F.lit("|"))
    names = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), ",")
    return out.select(
        "doc_id",
        F.replace(F.btrim("_marks", F.lit("<>")), F.lit("><"), F.lit(",")).alias("sentence_ids"),
        F.when(F.col("_marks") == "", "").otherwise(names).alias("licenses"),
    )
