"""License scans by sentence rules.

A text is cut into sentences at line ends and after closing punctuation. Sentences are
normalised (lower case, words and numbers only, one blank between) and looked up among
the known license sentences; a known sentence that was wrapped over several lines is
found by joining the pieces. What remains of a document is its sequence of sentence
identifiers with places, and licenses are recognised on that sequence alone: a rule names
a license and the identifiers that must follow each other in this order, with at most
GAP other known or unknown sentences between two of them. Rules of more sentences are
tried first, and a sentence serves one rule only.

Defined results: null and empty texts have no sentence and no license; a rule that
matches twice is reported twice, its license is named once; ties between rules of equal
length go to the one that comes first in RULES; places count sentences from 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

GAP = 3

# Known license sentences by identifier.
SENTENCES = {
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-licensed-the-license": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-compliance": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-distributed": (
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied"
    ),
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "MIT License",
    "mit-title-the": "The MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software"
    ),
    "as-is-software": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT"
    ),
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version"
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version"
    ),
    "gpl-useful": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    ),
    "mpl2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution"
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc0": "Licensed under CC0 1.0",
    "cc-by-nc-4-work": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License"
    ),
    "cc-by-4-work": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License"
    ),
    "all-rights": "All rights reserved",
    "as-is-bsd": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"
    ),
    "bsd-advertising": (
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement"
    ),
    "0bsd-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted"
    ),
    "gpl2-only-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software Foundation"
    ),
    "lgpl2-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version"
    ),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version"
    ),
    "lgpl3-free": (
        "This library is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version"
    ),
    "lgpl3-free-program": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version"
    ),
    "lgpl-useful": (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    ),
    "agpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version"
    ),
    "perl-terms": (
        "This library is free software; you can redistribute it and/or modify it under the same "
        "terms as Perl itself"
    ),
    "perl-terms-program": (
        "This program is free software; you can redistribute it and/or modify it under the same "
        "terms as Perl itself"
    ),
    "artistic-2": "You may distribute this program under the Artistic License 2.0",
    "epl1": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution"
    ),
    "epl2": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at"
    ),
    "mpl11": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1"
    ),
    "cddl1": (
        "The contents of this file are subject to the terms of the Common Development and "
        'Distribution License (the "License")'
    ),
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions"
    ),
    "zlib-origin": (
        "The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software"
    ),
    "boost": "Distributed under the Boost Software License, Version 1.0",
    "postgresql-grant": (
        "Permission to use, copy, modify, and distribute this software and its documentation for "
        "any purpose, without fee, and without a written agreement is hereby granted, provided "
        "that the above copyright notice and this paragraph and the following two paragraphs "
        "appear in all copies"
    ),
    "hpnd-grant": (
        "Permission to use, copy, modify, and distribute this software and its documentation for "
        "any purpose and without fee is hereby granted, provided that the above copyright notice "
        "appear in all copies and that both that copyright notice and this permission notice "
        "appear in supporting documentation"
    ),
    "ofl": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "unlicense-anyone": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means"
    ),
    "cc0-dedicated": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related "
        "and neighboring rights to this software to the public domain worldwide"
    ),
    "cc-by-sa-4-work": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License"
    ),
    "cc-by-nd-4-work": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License"
    ),
    "cc-by-nc-sa-4-work": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License"
    ),
    "cc-by-nc-nd-4-work": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives "
        "4.0 International License"
    ),
    "classpath-exception": (
        "As a special exception, the copyright holders of this library give you permission to link "
        "this library with independent modules to produce an executable, regardless of the license "
        "terms of these independent modules, and to copy and distribute the resulting executable "
        "under terms of your choice"
    ),
    "gcc-exception": (
        "Under Section 7 of GPL version 3, you are granted additional permissions described in the "
        "GCC Runtime Library Exception, version 3.1, as published by the Free Software Foundation"
    ),
    "llvm-exception": (
        "Part of the LLVM Project, under the Apache License v2.0 with LLVM Exceptions"
    ),
    "autoconf-exception": (
        "As a special exception to the GNU General Public License, if you distribute this file as "
        "part of a program that contains a configuration script generated by Autoconf, you may "
        "include it under the same distribution terms that you use for the rest of that program"
    ),
}

# License identifiers whose tag lines are known sentences.
TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-2.0",
    "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0",
    "OFL-1.1", "Unlicense", "Zlib",
)
SENTENCES |= {f"tag-{name}": f"SPDX-License-Identifier: {name}" for name in TAGGED}

# Fixed values: (license, identifiers in order).
RULES = (
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", ("apache-licensed-the-license", "apache-compliance", "apache-copy",
                    "apache-distributed")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice", "as-is-software")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-useful")),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-useful")),
    ("Apache-2.0", ("apache-licensed-the-license", "apache-compliance")),
    ("Apache-2.0", ("apache-licensed",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-2.0-only", ("gpl2-work",)),
    ("MPL-2.0", ("mpl2",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-work",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-4.0", ("cc-by-4-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("LicenseRef-all-rights-reserved", ("all-rights",)),
    ("BSD-4-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-advertising")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse",
                      "as-is-bsd")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "as-is-bsd")),
    ("0BSD", ("0bsd-grant",)),
    ("GPL-2.0-only", ("gpl2-only-free", "gpl-useful")),
    ("LGPL-2.0-or-later", ("lgpl2-free", "lgpl-useful")),
    ("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-useful")),
    ("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-useful")),
    ("LGPL-3.0-or-later", ("lgpl3-free-program", "gpl-useful")),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-useful")),
    ("Artistic-1.0-Perl OR GPL-1.0-or-later", ("perl-terms",)),
    ("Artistic-1.0-Perl OR GPL-1.0-or-later", ("perl-terms-program",)),
    ("Artistic-2.0", ("artistic-2",)),
    ("EPL-1.0", ("epl1",)),
    ("EPL-2.0", ("epl2",)),
    ("MPL-1.1", ("mpl11",)),
    ("CDDL-1.0", ("cddl1",)),
    ("Zlib", ("zlib-as-is", "zlib-grant", "zlib-origin")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("BSL-1.0", ("boost",)),
    ("PostgreSQL", ("postgresql-grant",)),
    ("HPND", ("hpnd-grant",)),
    ("OFL-1.1", ("ofl",)),
    ("Unlicense", ("unlicense", "unlicense-anyone")),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-work",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-work",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-work",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4-work",)),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", ("gpl2-free", "gpl-useful",
                                                       "classpath-exception")),
    ("GPL-3.0-or-later WITH GCC-exception-3.1", ("gpl-free", "gpl-useful", "gcc-exception")),
    ("Apache-2.0 WITH LLVM-exception", ("llvm-exception",)),
    ("GPL-2.0-or-later WITH Autoconf-exception-generic", ("gpl2-free", "gpl-useful",
                                                          "autoconf-exception")),
    ("GPL-3.0-or-later WITH Autoconf-exception-generic", ("gpl-free", "gpl-useful",
                                                          "autoconf-exception")),
)
RULES += tuple((name, (f"tag-{name}",)) for name in TAGGED)

_CUT = re.compile(r"\n|(?<=[.!?:;])\s")
_WORD = re.compile(r"[^\W_]+")


def normalised(sentence: str) -> str:
    return " ".join(_WORD.findall(sentence.lower()))


def sentences(text: str) -> list[str]:
    """The sentences that have words, as they stand."""
    return [s for s in _CUT.split(text) if _WORD.search(s)]


class Scanner:
    """Known sentences and rules, ready to scan texts."""

    def __init__(
        self,
        known: Mapping[str, str] = SENTENCES,
        rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
    ):
        self._ids = {normalised(s): name for name, s in known.items()}
        self._openings = {s.split(" ", 1)[0] for s in self._ids}
        # what a known sentence may begin with, up to any of its words
        self._prefixes = {
            " ".join(words[:n])
            for words in (s.split(" ") for s in self._ids)
            for n in range(1, len(words) + 1)
        }
        self._rules = sorted(rules, key=lambda rule: -len(rule[1]))
        # texts without the first two words of a known sentence in a row are done at once;
        # runs of other signs are possessive, so each is passed over once and time is linear
        seconds: dict[str, set[str]] = {}
        for first, *rest in (s.split(" ", 2) for s in self._ids):
            seconds.setdefault(first, set()).add(rest[0] if rest else "")
        pairs = [
            re.escape(first)
            + (rf"(?![^\W_])[\W_]++(?:{'|'.join(sorted(map(re.escape, after)))})" if all(after) else "")
            for first, after in sorted(seconds.items())
        ]
        self._quick = re.compile(rf"(?<![^\W_])(?:{'|'.join(pairs)})(?![^\W_])", re.IGNORECASE)

    def identifiers(self, text: str) -> list[tuple[int, str]]:
        """(place, identifier) of the known sentences; the longest known one at a place."""
        if not self._quick.search(text):
            return []
        found, parts, i = [], sentences(text), 0
        while i < len(parts):
            opening = _WORD.search(parts[i])[0].lower()
            name, taken = None, 1
            if opening in self._openings:
                joined = ""
                for n in range(len(parts) - i):  # ends with the longest known sentence
                    joined = f"{joined} {normalised(parts[i + n])}".strip()
                    if joined in self._ids:
                        name, taken = self._ids[joined], n + 1
                    if joined not in self._prefixes:
                        break
            if name:
                found.append((i, name))
            i += taken
        return found

    def matches(self, found: list[tuple[int, str]]) -> list[tuple[int, int, str]]:
        """(first place, last place, license) of the rules found in an identifier sequence."""
        used, matched = set(), []
        places: dict[str, list[int]] = {}
        for start, (_, name) in enumerate(found):
            places.setdefault(name, []).append(start)
        for license_, wanted in self._rules:
            for start in places.get(wanted[0], ()):
                if start in used:
                    continue
                chain = [start]
                for name in wanted[1:]:
                    last = chain[-1]
                    reach = found[last][0] + GAP + 1
                    near = takewhile(lambda i: found[i][0] <= reach, range(last + 1, len(found)))
                    after = next((i for i in near if found[i][1] == name and i not in used), None)
                    if after is None:
                        break
                    chain.append(after)
                if len(chain) == len(wanted):
                    used.update(chain)
                    matched.append((found[chain[0]][0], found[chain[-1]][0], license_))
        return sorted(matched)


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_known, sentence_ids, licenses, matches.

    Identifiers are comma-joined in their order, licenses by name; a match is shown as
    license:first:last.
    """
    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = []
            for start in range(0, batch.num_rows, 256):
                for whole in batch.column(1).slice(start, 256).to_pylist():
                    found = scanner.identifiers(whole or "")
                    matched = scanner.matches(found)
                    rows.append(
                        (
                            len(found),
                            ",".join(name for _, name in found),
                            ",".join(sorted({m[2] for m in matched})),
                            ",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in matched),
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_known", "sentence_ids", "licenses", "matches"],
            )

    added = [T.StructField("n_known", T.LongType())]
    added += [T.StructField(n, T.StringType()) for n in ("sentence_ids", "licenses", "matches")]
    return slim.mapInArrow(scanned, T.StructType([slim.schema["doc_id"], *added]))
