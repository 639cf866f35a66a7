"""Licence scans by recognising sentences and ordered rules over them.

A text is lower-cased and cut into sentences at sentence ends, once over line
ends but not over blank lines (also behind comment marks) and copyright lines,
and once at all line ends; other signs and white space become one space. A
sentence equal to a known licence sentence becomes its identifier, others are
left out. Of a notice ("this work is licensed under the ...", an SPDX line)
only the licence named counts, without words like "license" and "version", so
every usual wording of it has one identifier; so do titles ("The MIT License"), fields
("License: MIT") and, where the whole is no name, the names between "or", "and"
and "with" of an expression or dual licence. A rule is the ordered identifiers
of one licence text; it matches if a document holds them in that order, other
known sentences may stand between. A rule whose identifiers lie in order within a
longer one counts only outside what the longer one matched. All of it is built-in column functions in
one scan. A name without a version gives the family ("GPL", "CC-BY").

Edge cases: a null or empty text has no identifiers and no licence; texts of
any length are scanned whole; equal rows give equal rows; an empty table gives
an empty result; only the id and the text are read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of public licences and of usual notices.
LICENCE_TEXTS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "Released under the MIT License.", "Licensed under the MIT License.", "Distributed under the MIT License.",
        "This project is licensed under the MIT License.", "This software is released under the MIT License.",
        "SPDX-License-Identifier: MIT"],
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache License 2.0.", "Licensed under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0"],
    "BSD-3-Clause": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-2-Clause": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
        "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "GPL-2.0": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "Released under the GNU General Public License v3.0.", "Released under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
        "SPDX-License-Identifier: MPL-2.0"],
    "ISC": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "SPDX-License-Identifier: CC0-1.0"],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."],
    "LGPL-3.0": [
        f"This {x} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version." for x in ("library", "program")]
        + ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following:",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"],
    "Zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:"],
    "GFDL-1.3": ["GNU Free Documentation License Version 1.3, 3 November 2008"],
    "WTFPL": ["You just DO WHAT THE FUCK YOU WANT TO."],
}

# Names of public licences, "/" between them, in any wording that reduced() makes equal.
LICENCE_NAMES = {
    "MIT": "MIT/MIT (MIT)/Expat/MIT (Expat)/MIT/X11/Massachusetts Institute of Technology",
    "MIT-0": "MIT-0/MIT No Attribution/MIT No Attribution (MIT-0)",
    "Apache-2.0": "Apache 2/Apache Software 2/Apache2/ASL 2/AL2/Apache 2 (Apache-2.0)/Apache 2 (the License)/ASF 2",
    "Apache-1.1": "Apache 1.1/Apache Software 1.1", "Apache": "Apache/Apache Software/ASL",
    "0BSD": "0BSD/BSD Zero Clause/Zero Clause BSD/BSD 0 Clause",
    "BSD-2-Clause": "BSD 2 Clause/2 Clause BSD/Simplified BSD/FreeBSD/BSD 2/Two Clause BSD/BSD Two Clause/BSD 2 Clause Simplified",
    "BSD-3-Clause": "BSD 3 Clause/3 Clause BSD/New BSD/Modified BSD/Revised BSD/BSD 3/Three Clause BSD/BSD Three Clause/"
                    "BSD 3 Clause New or Revised/New or Revised BSD",
    "BSD-4-Clause": "BSD 4 Clause/4 Clause BSD/Original BSD/Old BSD/BSD 4 Clause Original or Old",
    "BSD": "BSD/BSD Style", "ISC": "ISC/ISC (ISC)/Internet Systems Consortium", "Unlicense": "Unlicense",
    "Zlib": "zlib/zlib libpng/zlib png", "WTFPL": "WTFPL/WTFPL 2/Do What The Fuck You Want To/"
                                                    "Do What The Fuck You Want To Public License 2",
    "BSL-1.0": "Boost/Boost 1/BSL 1/Boost 1 (BSL-1.0)", "BUSL-1.1": "BUSL 1.1/Business Source 1.1/Business Source",
    "MPL-1.1": "Mozilla 1.1/MPL 1.1", "MPL-2.0": "Mozilla 2/MPL 2/Mozilla 2 (MPL-2.0)/Mozilla (MPL) 2/MPL2",
    "MPL": "Mozilla/MPL", "EPL-1.0": "Eclipse 1/EPL 1/Eclipse 1 (EPL-1.0)",
    "EPL-2.0": "Eclipse 2/EPL 2/Eclipse 2 (EPL-2.0)/Eclipse (EPL) 2", "EPL": "Eclipse/EPL",
    "EDL-1.0": "Eclipse Distribution 1/EDL 1/Eclipse Distribution", "CDDL-1.0": "Common Development and Distribution 1/CDDL 1",
    "CDDL-1.1": "Common Development and Distribution 1.1/CDDL 1.1", "CDDL": "Common Development and Distribution/CDDL",
    "CPL-1.0": "Common Public 1/CPL 1", "EUPL-1.1": "European Union 1.1/EUPL 1.1",
    "EUPL-1.2": "European Union 1.2/EUPL 1.2/European Union (EUPL) 1.2", "EUPL": "European Union/EUPL",
    "Artistic-1.0": "Artistic 1", "Artistic-2.0": "Artistic 2", "Artistic": "Artistic/Perl Artistic",
    "AFL-3.0": "Academic Free 3/AFL 3", "OSL-3.0": "Open Software 3/OSL 3/Open 3", "MS-PL": "Microsoft/MS PL/Microsoft (MS-PL)",
    "MS-RL": "Microsoft Reciprocal/MS RL", "NCSA": "University of Illinois NCSA Open Source/NCSA/UIUC",
    "PostgreSQL": "PostgreSQL", "Python-2.0": "Python 2/Python Software Foundation 2/PSF 2/PSF/PSF 2.0/Python Software Foundation",
    "PHP-3.01": "PHP 3.01", "Ruby": "Ruby", "OFL-1.1": "SIL Open Font 1.1/OFL 1.1/SIL OFL 1.1/Open Font 1.1/SIL Open Font",
    "UPL-1.0": "Universal Permissive 1/UPL 1/Universal Permissive", "OpenSSL": "OpenSSL", "Vim": "Vim", "curl": "curl",
    "BlueOak-1.0.0": "Blue Oak Model 1/BlueOak 1", "MulanPSL-2.0": "Mulan Permissive 2/MulanPSL 2/Mulan PSL 2",
    "ECL-2.0": "Educational Community 2/ECL 2", "W3C": "W3C/W3C Software Notice and", "X11": "X11", "HPND": "HPND",
    "CECILL-2.1": "CeCILL 2.1", "CECILL-B": "CeCILL B", "CECILL-C": "CeCILL C", "CECILL-2.0": "CeCILL 2/CeCILL",
    "SSPL-1.0": "Server Side 1/SSPL 1/Server Side", "Elastic-2.0": "Elastic 2", "QPL-1.0": "Q 1/QPL 1", "QPL": "QPL",
    "ODbL-1.0": "Open Database 1/ODbL 1/Open Data Commons Open Database 1/Open Database/ODbL/ODC Open Database/"
                "Open Data Commons Open Database/Open Database (ODbL)/Open Database (ODbL) 1",
    "ODC-By-1.0": "ODC By 1/ODC By/Open Data Commons Attribution/Open Data Commons Attribution 1", "PDDL-1.0": "PDDL 1/PDDL/"
    "Open Data Commons Public Domain Dedication and", "GFDL-1.1": "GNU Free Documentation 1.1/GFDL 1.1",
    "GFDL-1.2": "GNU Free Documentation 1.2/GFDL 1.2", "GFDL-1.3": "GNU Free Documentation 1.3/GFDL 1.3",
    "GFDL": "GNU Free Documentation/GFDL/FDL", "OGL-UK-3.0": "Open Government 3/OGL 3/OGL UK 3", "OGL-UK": "Open Government/OGL",
    "CDLA-Permissive-2.0": "CDLA Permissive 2/Community Data Agreement Permissive 2",
    "CDLA-Permissive-1.0": "CDLA Permissive 1/Community Data Agreement Permissive 1",
    "CDLA-Sharing-1.0": "CDLA Sharing 1/Community Data Agreement Sharing 1",
    "CC0-1.0": "CC0/CC0 1/CC0 1 Universal/Creative Commons Zero/Creative Commons Zero 1 Universal/Creative Commons CC0/"
               "Creative Commons Zero 1/Creative Commons CC0 1/Creative Commons CC0 1 Universal/CC Zero/"
               "CC0 1 Universal Public Domain Dedication/Creative Commons CC0 1 Universal Public Domain Dedication",
}
for _short, _long, _versions in (
        ("GPL", ["General"], ["1", "2", "3"]), ("LGPL", ["Lesser General", "Library General"], ["2", "2.1", "3"]),
        ("AGPL", ["Affero General"], ["1", "3"])):
    _titles = [*_long, _short, *(f"{x} ({_short})" for x in _long)]
    LICENCE_NAMES[_short] = "/".join(_titles)
    for _v in _versions:
        _name = f"{_short}-{_v if '.' in _v else _v + '.0'}"
        LICENCE_NAMES[_name] = "/".join(
            [f"{x} {_v}/{_v} of {x}" for x in _titles] + [f"{_short}v{_v}/{_short}{_v}"]
            + [f"{x} {_v} ({y})" for x in _long for y in (f"{_short} {_v}", f"{_short}v{_v}", f"{_short}{_v}", _short)])
_WORDS = {"by": ["Attribution"], "nc": ["NonCommercial", "Non Commercial"], "sa": ["ShareAlike", "Share Alike"],
          "nd": ["NoDerivatives", "No Derivatives", "NoDerivs", "NoDerivative Works", "No Derivative Works"]}
for _kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
    _long = [""]
    for _w in _kind.split():
        _long = [f"{x} {w}" for x in _long for w in _WORDS[_w]]
    for _v in ("", "1", "2", "2.5", "3", "4"):
        _cc = f"CC {_kind} {_v}"
        _titles = [f"{x} {_v}" for x in (f"CC {_kind}", f"Creative Commons {_kind}", f"Creative Commons CC {_kind}",
                                         *(f"Creative Commons{x}" for x in _long), *(f"CC{x}" for x in _long))]
        _titles += [f"Creative Commons{x} {_v} ({_cc})" for x in _long] + [f"Creative Commons{x} ({_cc})" for x in _long]
        _name = f"CC-{_kind.upper().replace(' ', '-')}" + (f"-{_v if '.' in _v else _v + '.0'}" if _v else "")
        LICENCE_NAMES[_name] = "/".join(_titles)
LICENCE_NAMES["CC"] = "Creative Commons"

SENTENCE_END = "[.;:!?]+([\\x09-\\x0D\\x20]+|$)"
SHORT = "\\bv(er)?[.][\\x09-\\x0D\\x20]+([0-9])"
#: with comment marks that would end a sentence
NEW_LINE = "(\\x0D\\x0A?|\\x0A)[\\x09\\x20]*[;!]*"
#: a line that says whose copyright it is, and a line without letters and digits
COPYRIGHT = "(^|\\x0A)[^a-z0-9\\x0A]*copyright[\\x09\\x20]+(\\(c\\)|©|[0-9<\\[])[^\\x0A]*"
BLANK = "\\x0A[^a-z0-9\\x0A]*\\x0A"
LINE_END = "[\\x0A\\x0D]+"
NOISE = "[^a-z0-9|]+"
#: what stands before the name of a licence, behind a sentence end
NOTICE = ("(^|[|]) ?(spdx license identifier[ |]*|(((this|the|these|all|our|that|your|my|its)( [a-z0-9]+){1,8}? (is|are|be)|it is|"
          "they are|code|we are|you may use it) )?((dual|also|hereby|now|freely|openly|currently|made|being) )?"
          "(licen[cs]ed|released|distributed|published|provided|available|offered|shared|covered|issued|redistributable) "
          "(to you |for use |to the public )?(under|by|with|according to) (the )?((terms|conditions|provisions)"
          "( and conditions)? (of|in) )?(the |a |an )?)")
#: what can follow the name
AFTER = (" (see|https?|www|which|whose|as published|only|or later|or newer|or higher|or any later|or at your option|and later|"
         "available|found|a copy|in the|by the|with|for details|for more|unless|you may|except|where) ?.*$")
#: words that make no other licence
SMALL = "\\b(licen[cs]es?|version|v|the|gnu|international|intl|unported|generic|public|of|software|0)\\b"

#: a field that names the licence
FIELD = "(^|[\\x0A\\x0D])[^a-z0-9\\x0A\\x0D|]*licen[cs]e[\"']?[\\x09\\x20]*:[\\x09\\x20]*"
#: a sentence that is the name of a licence
TITLE = "^[a-z0-9 ]+ licen[cs]e( (version |v)?[0-9]( [0-9])?)?$"
TITLE_LENGTH = 80
#: what joins names, and words around them
JOINS = " (or|and|with) "
CHOICE = "\\b(either|both|one|any|at|your|option|choice)\\b"


def reduced(name: str) -> str:
    """A notice "under ..." as the name alone."""
    name = re.sub(AFTER, "", name + " ")
    return " ".join(re.sub(SMALL, " ", re.sub("\\bv([0-9])", "\\1", name)).split())


def sentences(text: str) -> list[str]:
    text = re.sub(NOISE, " ", re.sub(SENTENCE_END, "|", re.sub(SHORT, "v \\2", text.lower().replace("|", " "))))
    parts = [p.strip() for p in re.sub(NOTICE, "|under ", text).split("|")]
    return [reduced(p) if p.startswith("under ") else p for p in parts if p]


def rules(texts: dict[str, list[str]] | None = None) -> tuple[dict[str, int], list[tuple[str, list[int]]]]:
    """Identifiers of the sentences, and (licence, identifiers in order) rules."""
    known: dict[str, int] = {}
    found = []
    if texts is None:
        for licence, names in LICENCE_NAMES.items():
            for name in [licence, *names.split("/")]:
                notice, = sentences(f"licensed under {name}")
                if notice not in known:
                    known[notice] = next((i[0] for x, i in found if x == licence), len(found) + 1)
                    if known[notice] > len(found):
                        found.append((licence, [known[notice]]))
    last = max(known.values(), default=0)
    for licence, versions in (LICENCE_TEXTS if texts is None else texts).items():
        for text in versions:
            ids = []
            for s in sentences(text):
                if s not in known:
                    last += 1
                    known[s] = last
                ids.append(known[s])
            if (licence, ids) not in found:
                found.append((licence, ids))
    return known, found


def pattern(ids: list[int]) -> str:
    """Over identifiers written ``,1,2,3,``."""
    return "," + ",([0-9]+,)*".join(map(str, ids)) + ","


def patterns(found: list[tuple[str, list[int]]]) -> dict[str, list[str]]:
    """Patterns of each licence, by name."""
    by_name: dict[str, list[str]] = {}
    for licence, ids in sorted(found):
        by_name.setdefault(licence, []).append(pattern(ids))
    return by_name


def longer(found: list[tuple[str, list[int]]]) -> dict[str, list[tuple[list[int], list[list[int]]]]]:
    """By licence: its rules that lie within longer ones of other licences, with these."""
    def within(a, b):
        rest = iter(b)
        return len(a) < len(b) and all(x in rest for x in a)

    out: dict[str, list] = {}
    for licence, ids in found:
        around = [b for other, b in found if other != licence and within(ids, b)]
        if around:
            out.setdefault(licence, []).append((ids, sorted(around, key=len, reverse=True)))
    return out


def spans(ids: list[int]) -> list[str]:
    """What a longer rule matched: with nothing between its identifiers, then with as little as can be."""
    return [",(" + gap.join(f"{i}," for i in ids) + ")+" for gap in ("", "([0-9]+,)*?")]


def _ids(text: Column, known: dict[str, int], at_lines: bool) -> Column:
    text = F.regexp_replace(F.translate(F.lower(F.coalesce(text, F.lit(""))), "|", " "), SHORT, "v $2")
    text = F.regexp_replace(text, FIELD, "$1|spdx license identifier ")
    if at_lines:
        text = F.regexp_replace(text, LINE_END, "|")
    else:
        text = F.regexp_replace(text, NEW_LINE, "\n")
        text = F.regexp_replace(F.regexp_replace(text, COPYRIGHT, "|"), BLANK, "|")
    text = F.regexp_replace(F.regexp_replace(text, SENTENCE_END, "|"), NOISE, " ")
    text = F.regexp_replace(text, NOTICE, "|under ")
    notices = {s: i for s, i in known.items() if s.startswith("under ")}
    others = {s: i for s, i in known.items() if s not in notices}

    def look(table, s):
        both = (F.split(F.lit("|".join(map(str, x))), "[|]") for x in (table.keys(), table.values()))
        if not table:
            return F.lit(None).cast("string")
        # the map is searched from its start, so first whether a known sentence has this length (one sign per length)
        lengths = {len(k) for k in table}
        some = "".join("x" if n in lengths else "-" for n in range(max(lengths) + 1))
        return F.when(F.substr(F.lit(some), F.length(s) + 1, F.lit(1)) == "x", F.try_element_at(F.map_from_arrays(*both), s))

    def name(s):
        s = F.regexp_replace(F.regexp_replace(F.concat(s, F.lit(" ")), AFTER, ""), "\\bv([0-9])", "$1")
        return F.trim(F.regexp_replace(F.regexp_replace(s, SMALL, " "), " +", " "))

    def named(s):
        title = (F.length(s) < TITLE_LENGTH) & s.contains("licen") & s.rlike(TITLE) & look(others, s).isNull()
        return F.when(s.startswith("under "), name(s)).when(title, name(F.concat(F.lit("under "), s))).otherwise(s)

    def part(p):
        return look(notices, F.concat(F.lit("under "), F.trim(F.regexp_replace(F.regexp_replace(p, CHOICE, " "), " +", " "))))

    def identifiers(s):
        joined = s.startswith("under ") & s.rlike(JOINS) & look(notices, s).isNull()
        return F.when(joined, F.transform(F.split(F.substr(s, F.lit(7)), JOINS), part)) \
            .when(s.startswith("under "), F.array(look(notices, s))).otherwise(F.array(look(others, s)))

    pieces = F.transform(F.split(text, "[|]"), lambda s: named(F.trim(s)))
    found = F.filter(F.flatten(F.transform(pieces, identifiers)), lambda i: i.isNotNull())
    return F.regexp_replace(F.concat(F.lit(","), F.array_join(found, ","), F.lit(",")), "^,,$", "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         texts: dict[str, list[str]] | None = None) -> DataFrame:
    """id, sentence_ids (over line ends), line_ids (at them), licences (names, joined by commas)."""
    known, found = rules(texts)
    marked = docs.select(F.col(id_col), _ids(F.col(text_col), known, False).alias("sentence_ids"),
                         _ids(F.col(text_col), known, True).alias("line_ids"))
    both = F.concat("sentence_ids", F.lit("#"), "line_ids")
    inner = longer(found)

    def hit(both, licence, every):
        outside = [F.lit(False)]
        for ids, around in inner.get(licence, []):
            rest = both
            for span in (s for b in around for s in spans(b)):
                rest = F.regexp_replace(rest, span, ",")
            outside.append(rest.rlike(pattern(ids)))
        plain = [p for p in every if p not in {pattern(ids) for ids, _ in inner.get(licence, [])}]
        return reduce(lambda a, b: a | b, outside, both.rlike("|".join(plain)) if plain else F.lit(False))

    def names(both):
        hits = (F.when(hit(both, x, ps), F.lit(x)) for x, ps in patterns(found).items())
        return F.when(both == "#", "").otherwise(F.array_join(F.array_compact(F.array(*hits)), ","))

    # in a lambda: a filter on the names that is pushed below them then holds the identifiers' expression once
    return marked.withColumn("licences", F.element_at(F.transform(F.array(both), lambda b: names(b)), 1))


def scan_sql(table: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> str:
    """The same in DuckDB SQL."""
    known, found = rules()
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    notices = [s for s in known if s.startswith("under ")]
    others = [s for s in known if not s.startswith("under ")]
    base = f"regexp_replace(translate(lower(coalesce({text_col}, '')), '|', ' '), '{SHORT}', 'v \\2', 'g')"
    base = f"regexp_replace({base}, {quoted(FIELD)}, '\\1|spdx license identifier ', 'g')"
    at_lines = f"regexp_replace({base}, '[\\x0A\\x0D]+', '|', 'g')"

    by_paragraph = f"regexp_replace({base}, '{NEW_LINE}', chr(10), 'g')"
    by_paragraph = f"regexp_replace(regexp_replace({by_paragraph}, '{COPYRIGHT}', '|', 'g'), '{BLANK}', '|', 'g')"

    def ids(text):
        cut = f"regexp_replace(regexp_replace({text}, '[.;:!?]+([\\x09-\\x0D\\x20]+|$)', '|', 'g'), '[^a-z0-9|]+', ' ', 'g')"
        cut = f"regexp_replace({cut}, {quoted(NOTICE)}, '|under ', 'g')"

        def name(s):
            s = f"regexp_replace(regexp_replace({s} || ' ', {quoted(AFTER)}, ''), '\\bv([0-9])', '\\1', 'g')"
            return f"trim(regexp_replace(regexp_replace({s}, {quoted(SMALL)}, ' ', 'g'), ' +', ' ', 'g'))"

        look = lambda names, x: (f"[{', '.join(str(known[n]) for n in names)}]"  # noqa: E731
                                 f"[list_position([{', '.join(map(quoted, names))}], {x})]")
        known_other = f"list_contains([{', '.join(map(quoted, others))}], trim(s))"
        named = (f"CASE WHEN starts_with(trim(s), 'under ') THEN {name('trim(s)')} "
                 f"WHEN length(trim(s)) < {TITLE_LENGTH} AND contains(s, 'licen') AND regexp_matches(trim(s), {quoted(TITLE)}) "
                 f"AND NOT {known_other} THEN {name("'under ' || trim(s)")} ELSE trim(s) END")
        part = f"'under ' || trim(regexp_replace(regexp_replace(p, {quoted(CHOICE)}, ' ', 'g'), ' +', ' ', 'g'))"
        parts = f"list_transform(string_split_regex(substr(s, 7), {quoted(JOINS)}), lambda p: {look(notices, part)})"
        many = (f"CASE WHEN starts_with(s, 'under ') AND {look(notices, 's')} IS NULL AND regexp_matches(s, {quoted(JOINS)}) "
                f"THEN {parts} WHEN starts_with(s, 'under ') THEN [{look(notices, 's')}] ELSE [{look(others, 's')}] END")
        pieces = f"list_transform(string_split({cut}, '|'), lambda s: {named})"
        got = f"list_filter(flatten(list_transform({pieces}, lambda s: {many})), lambda i: i IS NOT NULL)"
        return f"coalesce(',' || nullif(array_to_string({got}, ','), '') || ',', '')"

    both, inner = "sentence_ids || '#' || line_ids", longer(found)

    def hit(licence, every):
        tests, inside = [], {pattern(ids) for ids, _ in inner.get(licence, [])}
        for ids, around in inner.get(licence, []):
            rest = both
            for span in (s for b in around for s in spans(b)):
                rest = f"regexp_replace({rest}, {quoted(span)}, ',', 'g')"
            tests.append(f"regexp_matches({rest}, {quoted(pattern(ids))})")
        plain = [p for p in every if p not in inside]
        return " OR ".join(tests + ([f"regexp_matches({both}, {quoted('|'.join(plain))})"] if plain else []))

    hits = ", ".join(f"CASE WHEN {hit(x, ps)} THEN {quoted(x)} END" for x, ps in patterns(found).items())
    return f"""SELECT {id_col}, sentence_ids, line_ids,
                      array_to_string(list_filter([{hits}], lambda x: x IS NOT NULL), ',') AS licences
               FROM (SELECT {id_col}, {ids(by_paragraph)} AS sentence_ids, {ids(at_lines)} AS line_ids FROM {table})"""
