"""License scans: license phrases, and templates with optional and replaceable regions.

A template is text with markup: `<<opt>> ... <<end>>` may be left out, `<<var N>>` stands for up to
N words of any kind, everything else is mandatory wording. It is compiled to an automaton over
words; a text is accepted where the automaton reads it from the first mandatory word to the last
without a difference in mandatory wording. Case, punctuation and line breaks are not compared.

After `<<rest>>` comes wording that an excerpt may lack as a whole: a text that ends its likeness
there is accepted too, unless what follows holds some of that wording, changed or moved. Of
templates that accept a text from the same word on, the one that reads furthest owns it.
"""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from locrank.llm.words import alphanumeric_words, column_bytes

#: Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY <<opt>>THE<<end>> <<var 12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED. IN NO EVENT SHALL <<opt>>THE<<end>> <<var 12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var 6>> and associated "
    "documentation files<<opt>> (the Software)<<end>>, to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice <<opt>>(including the next "
    "paragraph)<<end>> shall be included in all copies or substantial portions of the Software. "
)

_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL <<opt>>THE<<end>> <<var 12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. "
)

_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: <<opt>>1<<end>> Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. <<opt>>2<<end>> Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)

#: Public license texts and notices, by label.
TEMPLATES = [
    ("mit", _GRANT + _MIT_WARRANTY),
    ("json", _GRANT + "The Software shall be used for Good, not Evil. " + _MIT_WARRANTY),
    (
        "x11",
        _GRANT + _MIT_WARRANTY + "Except as contained in this notice, the name<<opt>>(s)<<end>> of <<var 12>> "
        "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software "
        "without prior written authorization from",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and<<opt>>/or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED AS IS AND <<var 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var 12>> BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("bsd-2-clause", _REDISTRIBUTION + _WARRANTY),
    (
        "bsd-3-clause",
        _REDISTRIBUTION + "<<opt>>3<<end>> Neither the name of <<var 12>> nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. " + _WARRANTY,
    ),
    (
        "mit-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var 6>> and associated "
        "documentation files<<opt>> (the Software)<<end>>, to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so. " + _MIT_WARRANTY,
    ),
    (
        "0bsd",
        "Permission to use, copy, modify, and<<opt>>/or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND <<var 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var 12>> BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the <<var 12>> be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: <<opt>>1<<end>> The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. <<opt>>2<<end>> Altered "
        "source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "<<opt>>3<<end>> This notice may not be removed or altered from any source distribution.",
    ),
    (
        "bsl-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
        "third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices "
        "in the Software and this entire statement, including the above license grant, this restriction and the "
        "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
        "works of the Software, unless such copies or derivative works are solely in the form of machine-executable "
        "object code generated by a source language processor. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING "
        "THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at <<var 12>> Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
]

#: One-line notices, which hold only where no word of NEGATIONS is among the NEAR words before.
NOTICES = [
    ("mit", "released under the <<opt>>terms of the<<end>> MIT License"),
    ("apache-2.0", "licensed under the Apache License <<opt>>Version<<end>> 2.0"),
    (
        "gpl-3.0",
        "licensed under the <<opt>>terms of the<<end>> GNU General Public License <<opt>>as published by the Free "
        "Software Foundation, either<<end>> version 3",
    ),
    ("cc-by-nc-4.0", "licensed under <<opt>>a Creative Commons<<end>> CC BY NC 4.0"),
    ("cc-by-4.0", "licensed under <<opt>>a Creative Commons<<end>> CC BY 4.0"),
]
NEGATIONS = {b"not", b"never", b"no", b"nor", b"neither", b"without", b"isn", b"aren", b"wasn", b"weren", b"cannot"}
NEAR = 4

_MARKUP = re.compile(r"<<(opt|end|var) ?(\d*)>>")

#: Words that start the search for a template.
_ANCHOR = 3


def compiled(template):
    """(anchor, words, skips, total, mandatory): the automaton of a template from its first mandatory
    word on, which is where its anchor begins.

    State k reads words[k] and goes to k + 1; None reads any word. skips[k] are the states that can
    be reached from k without reading: over an optional region, or out of a replaceable one.
    """
    words, skips, mandatory, opened = [], {}, [], []
    at = 0
    for mark in [*_MARKUP.finditer(template), None]:
        plain = alphanumeric_words(template[at : mark.start() if mark else None].encode())
        mandatory += [not opened] * len(plain)
        words += plain
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "opt":
            opened.append(len(words))
        elif mark[1] == "end":
            skips.setdefault(opened.pop(), set()).add(len(words))
        else:
            end = len(words) + int(mark[2])
            for state in range(len(words), end):
                skips.setdefault(state, set()).add(end)
            words += [None] * int(mark[2])
            mandatory += [False] * int(mark[2])
    start = mandatory.index(True)
    length = next((k for k in range(1, _ANCHOR) if not all(mandatory[start : start + k + 1])), _ANCHOR)
    length = min(length, len(words) - start)
    skips = {k - start: {to - start for to in v} for k, v in skips.items() if k >= start}
    return words[start : start + length], words[start:], skips, sum(mandatory[start:]), mandatory[start:]


def read(automaton, words, at):
    """(end, share): the end of the shortest accepted text from words[at] on, or None, and the share
    of the mandatory wording that was read before the text departed from it."""
    _, pattern, skips, total, mandatory = automaton
    done = [0]
    for flag in mandatory:
        done.append(done[-1] + flag)

    def closed(states):
        todo, out = list(states), set(states)
        while todo:
            for to in skips.get(todo.pop(), ()):
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return out

    states, best = closed({0}), 0
    while True:
        best = max(best, *(done[state] for state in states))
        if len(pattern) in states:
            return at, 1.0
        if at == len(words):
            return None, best / total
        word = words[at]
        states = closed({k + 1 for k in states if pattern[k] is None or pattern[k] == word})
        if not states:
            return None, best / total
        at += 1


def _places(joined, phrase):
    """Word positions at which a phrase starts in words that are joined and framed by spaces."""
    wanted, out, word, before = b" " + phrase + b" ", [], 0, 0
    at = joined.find(wanted)
    while at >= 0:
        word += joined.count(b" ", before, at)
        before = at
        out.append(word)
        at = joined.find(wanted, at + 1)
    return out


def scan_text(text, phrases, automata, notices=()):
    """n_words, n_base, first_word, last_word, base labels, labels, score of one text."""
    words = alphanumeric_words(text)
    joined = b" " + b" ".join(words) + b" "
    found = [(label, place) for phrase, label in phrases for place in _places(joined, phrase)]
    places = [place for _, place in found]
    base = {label for label, _ in found}
    share, accepted = 0.5 if base else 0.0, {}
    for label, automaton in [*automata, *notices]:
        is_notice = (label, automaton) in notices
        for place in _places(joined, b" ".join(automaton[0])):
            if is_notice and not NEGATIONS.isdisjoint(words[max(0, place - NEAR) : place]):
                continue
            end, read_share = read(automaton, words, place)
            if end is not None:
                accepted.setdefault(place, {}).setdefault(end, set()).add(label)
            share = max(share, 1.0 if end is not None else read_share / 2)
    labels = base.union(*(ends[max(ends)] for ends in accepted.values()))
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, sorted(base), sorted(labels), share


def license_scan(docs, phrases=None, templates=None, notices=None):
    """One row per row of docs(doc_id, text): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    n_base counts the places of all phrases, overlapping ones too; first_word and last_word are the
    smallest and the largest word at which one starts, null without any. labels adds to base_labels
    those of templates that accept a part of the text with all their mandatory wording, and of notices
    without a negation before them; of several from the same word on the one that reads furthest. score is 1 with an accepted template, else the
    larger of 0.5 for a phrase and half the largest share of a template's mandatory words that was
    read from its start.

    * A null or empty text has no words, no labels and the score 0.
    * Repeated rows and null doc_ids give a row each; empty docs give none; other columns are ignored.

    Each document is judged by itself, so there is no shuffle and no key.
    """
    phrases = [(" ".join(p.split()).encode(), label) for p, label in (phrases or PHRASES).items()]
    automata = [(label, compiled(text)) for label, text in (templates or TEMPLATES)]
    short = [(label, compiled(text)) for label, text in (NOTICES if notices is None else notices)]

    def scan(batches):
        for batch in batches:
            rows = [scan_text(text, phrases, automata, short) for text in column_bytes(batch, "text")]
            columns = list(zip(*rows)) if rows else [()] * 7
            strings = pa.list_(pa.string())
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), strings, strings, pa.float64()]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    layout = (
        f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>, labels array<string>, score double"
    )
    return docs.select("doc_id", "text").mapInArrow(scan, layout)


def op6_licenses(spark, sf_dir):
    """License phrases and templates in each document."""
    rows = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    return rows.withColumns(joined)
