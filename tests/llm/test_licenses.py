import random
import re

from locrank.llm.licenses import NOTICES, PHRASES, TEMPLATES, compiled, license_scan, op6_licenses, read, scan_text
from locrank.llm.words import alphanumeric_words

MIT = """Copyright (c) 2020 Somebody
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright
notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE."""
GRANT = MIT[: MIT.index(" THE SOFTWARE IS")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(text):
    own = words(text)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in found]
    base = ",".join(sorted({label for _, label in found}))
    return len(own), len(found), min(places, default=None), max(places, default=None), base


def test_automata():
    automaton = compiled("alpha beta <<opt>>gamma delta<<end>> of <<var 2>> omega")
    accepted = ["alpha beta of omega", "alpha beta gamma delta of x omega", "ALPHA, beta of x y omega"]
    for text in accepted:
        assert read(automaton, alphanumeric_words(text.encode()), 0)[0] is not None
    for text in ["alpha beta gamma of omega", "alpha beta of x y z omega", "alpha of omega", "alpha beta of"]:
        end, share = read(automaton, alphanumeric_words(text.encode()), 0)
        assert end is None and 0 < share < 1


def test_templates_accept_only_the_exact_mandatory_wording():
    automata, notices = ([(label, compiled(text)) for label, text in texts] for texts in (TEMPLATES, NOTICES))

    def labels(text):
        return scan_text(text.encode(), [], automata, notices)[5:]

    assert labels(MIT) == (["mit"], 1.0)
    assert labels(MIT.replace("this software and", "the big Thing and")) == (["mit"], 1.0)
    found, score = labels(MIT.replace("without restriction", "with restriction"))
    assert found == [] and 0 < score < 0.5
    assert labels("Licensed under the Apache License 2.0") == (["apache-2.0"], 1.0)
    assert labels("This file is not licensed under the Apache License 2.0")[0] == []
    for ending in ["", " More text.", " The authors give a full warranty and accept all liability for damages."]:
        found, score = labels(GRANT + ending)
        assert found == [] and 0 < score < 0.5
    assert labels("no license at all") == ([], 0.0)


WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_wording_up_to_the_last_clause():
    automata, notices = ([(label, compiled(text)) for label, text in texts] for texts in (TEMPLATES, NOTICES))

    def labels(text):
        return scan_text(text.encode(), [], automata, notices)[5:]

    grant = GRANT
    assert labels(grant + WARRANTY + " int main()") == (["mit"], 1.0)
    good = " The Software shall be used for Good, not Evil."
    assert labels(grant + good + WARRANTY) == (["json"], 1.0) and labels(grant + good)[0] == []
    except_ = " Except as contained in this notice, the name of Some Body shall not be used in advertising or otherwise to "
    except_ += "promote the sale, use or other dealings in this Software without prior written authorization from Some Body."
    assert labels(grant + WARRANTY + except_) == (["x11"], 1.0)
    changed = [WARRANTY.replace(*c) for c in [("WITHOUT", "WITH"), ("NONINFRINGEMENT", ""), ("THE SOFTWARE IS", "THE PROGRAM IS"), ("TORT OR", ""), ("IN NO", "IN ANY")]]
    for warranty in [*changed, " Pay first." + WARRANTY, WARRANTY[: WARRANTY.index("IN NO EVENT")]]:
        found, score = labels(grant + warranty)
        assert found == [] and 0 < score < 0.5
    filled = {"isc": "the author", "bsd-2-clause": "the holders", "bsd-3-clause": "the holders"}
    for label, name in filled.items():
        template = dict(TEMPLATES)[label]
        text = re.sub(r"<<(opt|end|var \d+)>>", lambda m: f" {name} " if m[1][0] == "v" else " ", template).replace("the the", "the")
        assert labels(text) == ([label], 1.0)
        assert labels(text[: text.index("IN NO EVENT")])[0] == [] and labels(text.replace("CONSEQUENTIAL", ""))[0] == []


def brute_force(template, rounds=4):
    """Word sequences a template accepts, by expanding its optional and replaceable regions with up to two words each."""
    parts = re.split(r"(<<opt>>.*?<<end>>|<<var \d+>>)", template)
    draw = random.Random(len(template))
    for _ in range(rounds):
        text = ""
        for part in parts:
            if part.startswith("<<opt>>"):
                part = part[7:-7] if draw.random() < 0.5 else ""
            elif part.startswith("<<var"):
                part = " ".join(draw.choices(["zeta", "eta", "theta"], k=draw.randint(0, 2)))
            text += " " + part
        yield words(text)


def test_full_texts_against_their_expansions():
    """Every expansion of a text is accepted, and none with a mandatory word left out, changed or doubled."""
    draw = random.Random(6)
    assert len({label for label, _ in TEMPLATES}) >= 10
    for label, template in TEMPLATES:
        automaton = compiled(template)
        plain = set(words(re.sub(r"<<opt>>.*?<<end>>|<<var \d+>>", " ", template)))
        for own in brute_force(template):
            coded = [word.encode() for word in own]
            assert read(automaton, coded, 0) == (len(coded), 1.0)
            for _ in range(10):
                at = draw.randrange(len(own))
                if own[at] in plain - {"the", "or", "s", "1", "2", "3"}:
                    assert read(automaton, [*coded[:at], b"else", b"else", *[b"x"] * 12, *coded[at + 1 :]], 0)[0] is None


def test_labels_of_the_tables_against_a_search(spark, sf_dir):
    """Labels of every document, by looking for the notices and the expanded texts as plain word sequences."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    forms = []
    for label, template in NOTICES:
        for kept in ("", r"\1"):
            forms.append((label, words(re.sub(r"<<opt>>(.*?)<<end>>", kept, template))))
    for r in op6_licenses(spark, sf_dir).collect():
        own, found = words(texts[r.doc_id]), set(r.base_labels.split(",")) - {""}
        ends = {}
        for label, form in forms:
            for i in range(len(own) - len(form) + 1):
                if own[i : i + len(form)] == form and not {"not", "never", "no", "without"} & set(own[max(0, i - 4) : i]):
                    ends.setdefault(i, {})[len(form)] = label
        found |= {by_end[max(by_end)] for by_end in ends.values()}
        assert set(r["labels"].split(",")) - {""} == found
        assert (r.score == 1.0) == bool(ends)


def test_mandatory_words_before_an_optional_region_are_read():
    automata = [("x", compiled("alpha <<opt>>x<<end>> beta gamma"))]
    for text, found in [("alpha beta gamma", ["x"]), ("alpha x beta gamma", ["x"]), ("beta gamma", []), ("so x beta gamma", [])]:
        assert scan_text(text.encode(), [], automata)[5] == found


def test_edge_cases(spark, frame, edge_cases):
    texts = [*edge_cases, (40, "MIT-License mit license cc by cc by, GNU general public license"), (41, MIT)]
    found = license_scan(frame(texts)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) for r in found), key=repr)
    assert got == sorted(((d, *by_hand(t)) for d, t in texts), key=repr)
    assert all(set(r.base_labels) <= set(r["labels"]) and 0 <= r.score <= 1 for r in found)
    assert license_scan(frame([])).count() == 0


def test_op6_on_the_tables(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op6_licenses(spark, sf_dir).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == by_hand(texts[r.doc_id])
