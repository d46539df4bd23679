"""License scans: sentences with known identifiers, and rules that are ordered sequences of them."""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame

from tidemark.llm.batches import add_columns

#: License sentences as their licenses and notices have them.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-free-2": "This program is free software;",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0-notice": "Released under CC0 1.0 Universal.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit-0-grant": "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software,",
    "zlib-warranty": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "apache-title": "Apache License Version 2.0, January 2004",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "lgpl-free": "This library is free software;",
    "lgpl21-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl11-notice": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\");",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl-terms": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE",
    "eupl-notice": "This Work is provided under the terms of the European Union Public Licence v. 1.2.",
    "ofl-notice": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "wtfpl-terms": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    "python-title": "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2",
    "artistic2-title": "The Artistic License 2.0",
    "cddl-title": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0",
    "cc0-title": "CC0 1.0 Universal",
    "ncsa-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction,",
    "beerware": "As long as you retain this notice you can do whatever you want with this stuff.",
    "sspl-title": "Server Side Public License VERSION 1, OCTOBER 16, 2018",
    "busl-title": "Business Source License 1.1",
    "busl-terms": "The Licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use of the Licensed Work.",
    "verbatim-copies": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "cc-not-a-law-firm": "CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES.",
}

#: SPDX identifiers and the names that prose has for them, longest forms of a version.
NAMES = {
    "MIT": ["MIT License", "MIT licence", "Expat License"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "2-clause BSD license", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "3-clause BSD license", "Modified BSD License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2", "GPL v2", "GNU GPL v2"],
    "GPL-3.0-only": ["GNU General Public License v3.0", "GPLv3", "GPL v3", "GNU GPL v3"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL v2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL v3"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL v3"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0"],
    "EUPL-1.2": ["EUPL 1.2", "European Union Public Licence 1.2", "European Union Public License 1.2"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "Boost Software License"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "OFL-1.1": ["SIL Open Font License 1.1", "SIL Open Font License, Version 1.1"],
    "PostgreSQL": ["PostgreSQL License"],
    "PSF-2.0": ["Python Software Foundation License"],
    "WTFPL": ["WTFPL"],
    "MS-PL": ["Microsoft Public License", "Ms-PL"],
    "MIT-0": ["MIT No Attribution License", "MIT-0 License"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0", "Creative Commons Zero v1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"],
    "CC-BY-SA-3.0": ["CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"],
    "ODbL-1.0": ["Open Database License", "Open Data Commons Open Database License"],
    "SSPL-1.0": ["Server Side Public License"],
    "BUSL-1.1": ["Business Source License 1.1"],
    "UPL-1.0": ["Universal Permissive License"],
    "NCSA": ["University of Illinois/NCSA Open Source License"],
    "AFL-3.0": ["Academic Free License 3.0", "Academic Free License version 3.0"],
    "ECL-2.0": ["Educational Community License, Version 2.0"],
    "Vim": ["Vim License"],
    "X11": ["X11 License"],
}

#: What stands before such a name where a text says that it holds; "the" and "terms of the" may stand between.
GRANTS = ["licensed under", "released under", "distributed under", "available under", "published under", "provided under", "covered by", "subject to"]

#: SPDX identifiers and the sentences that make them up, in order.
RULES = [
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("ISC", ["isc-grant"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("Unlicense", ["unlicense"]),
    ("0BSD", ["0bsd-grant"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-warranty", "zlib-grant"]),
    ("Apache-2.0", ["apache-title"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("LGPL-3.0", ["lgpl3-title"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("AGPL-3.0", ["agpl3-title"]),
    ("GPL-3.0-or-later", ["gpl-free-2", "gpl3-terms"]),
    ("GPL-2.0-or-later", ["gpl-free-2", "gpl2-terms"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl21-terms"]),
    ("LGPL-2.1-or-later", ["gpl-free", "lgpl21-terms"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl3-terms"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-terms"]),
    ("MPL-1.1", ["mpl11-notice"]),
    ("EPL-2.0", ["epl2-title", "epl-terms"]),
    ("EPL-1.0", ["epl1-title", "epl-terms"]),
    ("EUPL-1.2", ["eupl-notice"]),
    ("OFL-1.1", ["ofl-notice"]),
    ("WTFPL", ["wtfpl-terms"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("PSF-2.0", ["python-title"]),
    ("Artistic-2.0", ["artistic2-title", "verbatim-copies"]),
    ("CDDL-1.0", ["cddl-title"]),
    ("CC0-1.0", ["cc0-title", "cc-not-a-law-firm"]),
    ("NCSA", ["ncsa-grant"]),
    ("Beerware", ["beerware"]),
    ("SSPL-1.0", ["sspl-title"]),
    ("BUSL-1.1", ["busl-title", "busl-terms"]),
    ("MIT-0", ["mit-0-grant"]),
]

# A known sentence ends at a stop before white space, but for the one of a version; then the parts follow each other.
_END = re.compile(r"(?<!\bv)[.:;!?](?=\s|$)|\n\s*\n|\n(?=\s*(?:[A-Z]|\d+\.\s|[-*]\s))")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_WORD = re.compile(r"[^\W_]+")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() -]+)")
_SPDX_ID = re.compile(r"[A-Za-z0-9.+-]+")
_SPDX_WORDS = {"AND", "OR", "WITH"}


def normalised(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def notices() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Sentences "<grant> [the] [terms of the] <name>" for every name, and a rule for each."""
    sentences, rules = {}, []
    for spdx, names in NAMES.items():
        for k, name in enumerate(names):
            for g, grant in enumerate(GRANTS):
                for t, between in enumerate(("", "the ", "the terms of the ", "terms of the ")):
                    key = f"{spdx.lower()}-name-{k}-{g}-{t}"
                    sentences[key] = f"{grant} {between}{name}"
                    rules.append((spdx, [key]))
    return sentences, rules


class Recognizer:
    """Maps sentences to identifiers wherever they stand, within longer ones too, and identifier sequences to licenses."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, list[str]]]):
        self.known: dict[str, str] = {}
        same: dict[str, str] = {}
        for name, text in sentences.items():
            for k, piece in enumerate(p for p in map(normalised, _END.split(text)) if p):
                self.known.setdefault(piece, f"{name}/{k}")
                same.setdefault(f"{name}/{k}", self.known[piece])
        pieces = {name: [same[f"{name}/{k}"] for k in range(sum(1 for p in map(normalised, _END.split(text)) if p))] for name, text in sentences.items()}
        self.rules = sorted({(spdx, tuple(x for s in parts for x in pieces[s])) for spdx, parts in rules})
        self.by_start: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        for piece, name in sorted(self.known.items(), key=lambda x: -len(x[0])):
            words = tuple(piece.split())
            self.by_start.setdefault(" ".join(words[:2]), []).append((words, name))
        self.rules_of: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
        for spdx, rule in self.rules:
            self.rules_of.setdefault(rule[0], []).append((spdx, rule))
        # Each known sentence has one of these words, its longest but for common verbs, in any text that contains it.
        common = {"the", "terms", "of", "by", *(w for g in GRANTS for w in g.split())}
        telling = {max([w for w in s.split() if w not in common] or s.split(), key=len) for s in self.known}
        self.hint = re.compile(rf"(?<![^\W_])(?:{'|'.join([*sorted(map(re.escape, telling)), 'spdx'])})(?![^\W_])")

    def sequence(self, text: str) -> list[tuple[str, int]]:
        """(identifier, character position) of the known sentences of a text, in order; of two at a place the longer one, and
        none within another. An SPDX line gives ``spdx/<identifier>`` for each license in it."""
        lower = text.lower()
        if not self.hint.search(lower):
            return []
        out = [(f"spdx/{i}", m.start()) for m in _SPDX.finditer(text) for i in _SPDX_ID.findall(m[1]) if i not in _SPDX_WORDS]
        for first, last in self._stretches(lower):
            places = [(m[0], m.start()) for m in _WORD.finditer(lower, first, last)]
            words = [w for w, _ in places]
            at = 0
            while at < len(words):
                step = 1
                for known, name in [*self.by_start.get(" ".join(words[at : at + 2]), ()), *self.by_start.get(words[at], ())]:
                    if tuple(words[at : at + len(known)]) == known:
                        out.append((name, places[at][1]))
                        step = len(known)
                        break
                at += step
        return sorted(out, key=lambda x: (x[1], x[0]))

    def _stretches(self, text: str):
        """Paragraphs that hold a hint: a sentence doesn't go over a blank line, so the others need not be cut into words."""
        start = 0
        for m in _BLANK.finditer(text):
            if self.hint.search(text, start, m.start()):
                yield start, m.start()
            start = m.end()
        if self.hint.search(text, start):
            yield start, len(text)

    def licenses(self, sequence: list[str]) -> list[str]:
        """Licenses of the places where a rule's sentences occur in order, other sentences between them allowed.

        Each rule is matched from every place its first sentence stands at, to the next place of each further one. A match whose places
        all belong to a longer match gives way to it; at other places of the text it counts.
        """
        where: dict[str, list[int]] = {}
        for k, name in enumerate(sequence):
            where.setdefault(name, []).append(k)
        matches = []
        for first in where:
            for spdx, rule in self.rules_of.get(first, ()):
                if all(s in where for s in rule):
                    ending: dict[int, frozenset[int]] = {}
                    for start in where[first]:
                        at = [start]
                        for s in rule[1:]:
                            k = bisect_right(where[s], at[-1])
                            if k == len(where[s]):
                                break
                            at.append(where[s][k])
                        if len(at) == len(rule):
                            ending[at[-1]] = frozenset(at)  # of several that end here, the one that starts last
                    matches += [(spdx, at) for at in ending.values()]
        longest: dict[int, list[frozenset[int]]] = {}
        for _, at in matches:
            for k in at:
                longest.setdefault(k, []).append(at)
        found = {spdx for spdx, at in matches if not any(at < other for other in longest[min(at)])}
        return sorted(found | {name[5:] for name in where if name.startswith("spdx/")})


@lru_cache(maxsize=1)
def recognizer() -> Recognizer:
    sentences, rules = notices()
    return Recognizer({**SENTENCES, **sentences}, RULES + rules)


def scan_licenses(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """License sentences of each whole text: ``sentences`` (identifiers in text order) and ``licenses`` (sorted SPDX identifiers).

    One row for each input row. A null or empty text has neither. Repeated rows and null ids stay, an empty table
    gives an empty result, other columns are not read.
    """

    def work():
        known = recognizer()

        def step(part):
            found = [[name for name, _ in known.sequence(t)] if t else [] for t in part[text_column]]
            return {"sentences": found, "licenses": [known.licenses(f) if f else [] for f in found]}

        return step

    return add_columns(docs, [id_column], [text_column], work, {"sentences": "array<string>", "licenses": "array<string>"})
