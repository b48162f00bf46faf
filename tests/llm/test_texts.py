"""Operators on whole texts: brute force, held-out accuracy, round trips, odd inputs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cases import LONG, ODD, documents, rows, with_clashes, words
from dockflow.llm import license_scan, near_dedup, pieces, quality_crf, rules_forest, toxicity
from dockflow.llm.links import components
from dockflow.llm.wordgrid import ALNUM, NOT_SPACE, Words, slices

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHA = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [d[1] or "" for d in ODD] + ["a\n\na b\na\n a\n", "|x| #1 $2% a a a b a a a", "ONE two.three", "é\n\né\nÉ"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_and_hashes():
    for table, pattern in ((NOT_SPACE, SPACED), (ALNUM, ALPHA)):
        texts = [lower(t) for t in TEXTS]
        grid = Words([t.encode() for t in texts], table)
        found = [bytes(grid.buffer[a:b]).decode() for a, b in zip(grid.start, grid.end)]
        assert found == [w for t in texts for w in pattern.findall(t)]
        assert len(set(grid.hash.tolist())) == len(set(found))
        by = {}
        assert all(by.setdefault(w, h) == h for w, h in zip(found, grid.hash.tolist()))


# --- rules ---------------------------------------------------------------------------------
def base_statistics(text):
    found, seen, dup = SPACED.findall(text), set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:]))
    twice = {k + i for k in range(len(found) - 2) if windows[tuple(found[k:k + 3])] > 1 for i in range(3)}
    return [len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(twice)]


def test_statistics():
    got = rules_forest.statistics([t.encode() for t in TEXTS])[rules_forest.COUNTS].to_numpy().tolist()
    assert got == [base_statistics(t) for t in TEXTS]


@pytest.fixture(scope="module")
def judged_docs(spark):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        bad, toxic = i % 6 == 0, i % 5 == 0
        tokens = [f"{draw.choice(['ta', 'mo', 'ri'])}{draw.choice(['lan', 'sor', 'vep'])}{draw.randrange(40)}"
                  for _ in range(draw.randrange(60, 160))]
        if toxic:
            for _ in range(4):
                tokens[draw.randrange(len(tokens))] = draw.choice(["vilewort", "mudgrub"])
        if bad:
            tokens = [t + draw.choice(["$$$", "%%%", "###"]) for t in tokens]
        lines = [" ".join(tokens[k:k + 12]) + "." for k in range(0, len(tokens), 12)]
        docs.append((i, "\n".join(lines), "en", "a", 1))
        labels.append((i, int(not bad), int(toxic)))
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_forest_rejects_odd_rows(spark, judged_docs):
    docs, labels = judged_docs
    got = {r.doc_id: r for r in rules_forest.judge(docs, labels).collect()}
    kept = [got[i].kept for i in range(600) if i % 6]
    dropped = [not got[i].kept for i in range(0, 600, 6)]
    assert sum(kept) >= 0.97 * len(kept) and sum(dropped) >= 0.9 * len(dropped)


def test_threshold():
    good, bad = [(b, 1, 10) for b in range(300, 500)], [(b, 0, 5) for b in range(450, 700)]
    limit = rules_forest.threshold(good + bad, 0.01)
    assert 0.495 <= limit <= 0.5
    assert rules_forest.threshold(good, 0.01) == 2.0 and rules_forest.threshold([], 0.01) == 2.0


def test_paths_isolate():
    draw = np.random.default_rng(0)
    x = np.vstack([draw.normal(0, 1, (400, 2)), [[9.0, 9.0]]])
    score = rules_forest.anomaly(rules_forest.grow(x, 1), x, len(x))
    assert score.argmax() == 400 and (score > 0).all() and (score < 1).all()
    tied = rules_forest.anomaly(rules_forest.grow(x[:1].repeat(5, 0), 1), x, 5)
    assert len(set(tied.tolist())) == 1  # rows that tie cannot be split


# --- CRF -------------------------------------------------------------------------------------
def brute_marginals(odds, link):
    n, total, good = len(odds), 0.0, np.zeros(len(odds))
    for state in range(2 ** n):
        y = [(state >> i) & 1 for i in range(n)]
        weight = np.exp(sum(odds[i] * y[i] for i in range(n)) + sum(link[a, b] for a, b in zip(y, y[1:])))
        total += weight
        good += weight * np.array(y)
    return good / total, np.log(total)


def test_forward_backward():
    draw = np.random.default_rng(1)
    link = draw.normal(size=(2, 2))
    counts = [1, 4, 2, 7]
    text = np.repeat(np.arange(4), counts)
    odds = draw.normal(size=len(text))
    good, _, norm = quality_crf.marginals(odds, text, link)
    _, _, order = quality_crf._layout(text)
    for t in range(4):
        want, log_total = brute_marginals(odds[text == t], link)
        assert np.allclose(good[text == t], want) and np.isclose(norm[list(order).index(t)], log_total)


def test_likelihood_of_hidden_lines():
    draw = np.random.default_rng(2)
    counts, label = [1, 3, 6], np.array([1, 0, 1])
    text = np.repeat(np.arange(3), counts)
    share = draw.random(len(text))
    share /= np.bincount(text, share)[text]
    odds, link = draw.normal(size=len(text)), draw.normal(size=(2, 2))

    def brute(odds, link):
        out = []
        for t in range(3):
            own, part, sums = odds[text == t], share[text == t], np.zeros(2)
            for state in range(2 ** len(own)):
                y = np.array([(state >> i) & 1 for i in range(len(own))])
                chain = own @ y + sum(link[a, b] for a, b in zip(y, y[1:]))
                for k in (0, 1):
                    sums[k] += np.exp(chain + quality_crf.AGREE * part[y == k].sum())
            out.append(np.log(sums[label[t]] / sums.sum()))
        return np.array(out)

    got, by_odds, by_link = quality_crf.label_likelihood(odds, share, text, link, label)
    assert np.allclose(got, brute(odds, link))
    for i in range(len(odds)):
        step = np.eye(len(odds))[i] * 1e-5
        assert np.isclose(by_odds[i], (brute(odds + step, link) - brute(odds - step, link)).sum() / 2e-5, atol=1e-6)
    for a, b in np.ndindex(2, 2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert np.isclose(by_link[a, b], (brute(odds, link + step) - brute(odds, link - step)).sum() / 2e-5, atol=1e-6)


def test_mixed_texts_get_mixed_lines(judged_docs):
    """Lines of bad texts put into good ones, and texts that are longer than the run fitted on."""
    docs, labels = judged_docs
    texts = {r.doc_id: r.text.split("\n") for r in docs.filter("doc_id < 120").collect()}
    model = quality_crf.train(docs, labels)
    bad = [line for i, lines in texts.items() if i % 6 == 0 for line in lines[:-1]]
    low, high, whole = [], [], []
    for n, lines in enumerate(lines for i, lines in texts.items() if i % 6):
        at = len(lines) // 2
        value, good = quality_crf.score(["\n".join([*lines[:at], bad[n % len(bad)], *lines[at:]]).encode()], model)
        low.append(good[0][at] < 0.5)
        high.extend(np.delete(good[0], at) >= 0.5)
        whole.append(value[0] >= quality_crf.ACCEPT)
    assert sum(low) >= 0.95 * len(low) and sum(high) >= 0.95 * len(high) and sum(whole) >= 0.95 * len(whole)


def test_long_labelled_texts_are_fitted_on(spark, monkeypatch):
    monkeypatch.setattr(quality_crf, "TRAIN_LINES", 20)
    docs = [(i, "\n".join([f"{'good words here now' if i % 2 else '### $$$ %%% x1'} {k}" for k in range(50 + i)]), "en", "a", 1)
            for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = quality_crf.judge(documents(spark, docs), labels).collect()
    assert all(r.predicted == r.doc_id % 2 and len(r.lines) == 50 + r.doc_id for r in got)
    assert quality_crf.accepted(documents(spark, docs), labels).count() == 20


def test_accepted_takes_odd_rows(spark, judged_docs):
    labels = judged_docs[1]
    odd = with_clashes(spark)
    kept = quality_crf.accepted(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= len(ODD)
    assert quality_crf.accepted(with_clashes(spark, []), labels).count() == 0


def test_quality_on_held_out_rows(judged_docs):
    docs, labels = judged_docs
    got = quality_crf.judge(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    held = [r.predicted == int(r.doc_id % 6 != 0) for r in got if r.held_out]
    assert sum(held) >= 0.95 * len(held) > 0
    kept = quality_crf.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


# --- toxicity -----------------------------------------------------------------------------------
def brute_segments(scores):
    """All maximal scoring segments by their definition: the best segment, then those left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
               default=(0,))
    if best[0] <= 0:
        return []
    a, b = best[3], best[4]
    return brute_segments(scores[:a]) + [(a, b, best[0])] + [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]


def test_segments():
    draw = random.Random(5)
    for _ in range(200):
        scores = [draw.choice([-2.25, -1.5, -0.625, 1.0, 2.125, 3.0625]) for _ in range(draw.randrange(1, 14))]
        total = np.concatenate([[0], np.cumsum(scores)])
        runs = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(total[runs], total[[r + 1 for r in runs]])
        got = [(runs[a], runs[b] + 1, s) for a, b, s in found]
        assert sorted(s for _, _, s in got) == sorted(s for _, _, s in brute_segments(scores))


def test_toxicity_on_held_out_rows(judged_docs):
    docs, labels = judged_docs
    got = toxicity.judge(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.predicted == int(r.doc_id % 5 == 0) for r in got if r.held_out]
    assert sum(held) >= 0.95 * len(held) > 0
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        for p in r.passages:
            found = ALPHA.findall(text[r.doc_id])
            assert {found[p.first_word], found[p.last_word]} & {"vilewort", "mudgrub"}


# --- licences ------------------------------------------------------------------------------------
LICENCE_TEXTS = [
    "Released under the MIT License. mit-license", "under MIT\nlicense or the Apache License, Version 2.0",
    "Lesser General Public License", "mit licensex xmit license", "général public license",
    "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause", "SPDX-License-Identifier: MIT OR",
    "mit license " * 300, "", None]


def test_base_places(spark):
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(LICENCE_TEXTS)])
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, text in enumerate(LICENCE_TEXTS):
        found = ALPHA.findall(lower(text or ""))
        places = [(k, label) for phrase, label in license_scan.BASE_PHRASES.items() for k in range(len(found))
                  if found[k:k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(found), len(places), min((k for k, _ in places), default=None),
            max((k for k, _ in places), default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert all(found[s.word:s.word + len(s.phrase.split())] == s.phrase.split() for s in r.spans)
    assert got[5].labels == "bsd,gpl,mit" and got[5].duty == 1 and got[5].score == 1.0
    assert got[6].score == 0.4 and got[2].labels == "gpl,lgpl" and got[8].labels == ""


@pytest.mark.parametrize("text, labels, score, duty", [
    ("SPDX-License-Identifier: MIT. See the LICENSE file.", "mit", 1.0, 1),
    ("/* SPDX-License-Identifier: MIT */ function a(){}", "mit", 1.0, 1),
    ("(SPDX-License-Identifier: MIT) and more", "mit", 1.0, 1),
    ("<!-- SPDX-License-Identifier: GPL-2.0-only OR MIT --><p>or else</p>", "gpl,mit", 1.0, 1),
    ("SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-3.0-or-later", "gpl,mit", 1.0, 3),
    ("/* SPDX-License-Identifier: MIT */ /* SPDX-License-Identifier: (Apache-2.0) */", "apache,mit", 1.0, 1),
    ("SPDX-License-Identifier: MIT or GPL-2.0 at your option", "gpl,mit", 1.0, 1),
    ("SPDX-License-Identifier: MIT and see the file", "mit", 1.0, 1),
    ("SPDX-License-Identifier: (MIT OR GPL-2.0) AND BSD-3-Clause (see below)", "bsd,gpl,mit", 1.0, 1),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 applies here", "gpl", 1.0, 2),
    ("SPDX-License-Identifier: WTFPL is short", "wtfpl", 1.0, 3),
    ("SPDX-License-Identifier: MIT OR */ x = 1", "", 0.4, None),
    ("SPDX-License-Identifier: (MIT see file", "", 0.4, None),
    ("SPDX-License-Identifier: SEE LICENSE IN file", "", 0.4, None),
    ("The SPDX-License-Identifier: line names it", "", 0.4, None),
    ("// SPDX-License-Identifier: MIT OR Foo\n// and a next line", "foo,mit", 1.0, 1)])
def test_tags_before_prose_code_and_tags(text, labels, score, duty):
    row = license_scan.summary(*license_scan.scan_text(text.encode(), license_scan.automaton()))
    got = dict(zip(license_scan._columns(), row))
    assert (got["labels"], got["score"], got["duty"]) == (labels, score, duty)


@pytest.mark.parametrize("text, order, duty", [
    ("MIT", "MIT", 1), ("MIT OR Apache-2.0 AND GPL-2.0", "MIT Apache-2.0 GPL-2.0 and or", 1),
    ("(MIT OR Apache-2.0) AND GPL-3.0-or-later", "MIT Apache-2.0 or GPL-3.0-or-later and", 3),
    ("GPL-2.0 WITH Classpath-exception-2.0 and MIT", "GPL-2.0 Classpath-exception-2.0 with MIT and", 2),
    ("MIT AND", None, None), ("(MIT", None, None), ("MIT)", None, None), ("MIT MIT", None, None), ("", None, None),
    ("()", None, None), ("OR MIT", None, None)])
def test_expressions(text, order, duty):
    assert license_scan.postfix(text) == (order.split() if order else None)
    value = license_scan.evaluate(text)
    assert (value and value[1]) == duty


# --- near duplicates -------------------------------------------------------------------------------
def longest_common(x, y):
    best = [0] * (len(y) + 1)
    for a in x:
        row = [0]
        for j, b in enumerate(y):
            row.append(best[j] + 1 if a == b else max(best[j + 1], row[-1]))
        best = row
    return best[-1]


def edited(text, rate, draw):
    return " ".join(w if draw.random() > rate else f"new{draw.randrange(9999)}" for w in text.split())


def test_alignment_decides_as_the_full_one():
    draw = random.Random(6)
    seen = Counter()
    for _ in range(150):
        a = words(draw.randrange(6, 90), draw.randrange(500))
        b = edited(a, draw.choice([0, 0.01, 0.03, 0.05]), draw)
        if draw.random() < 0.3:
            tokens = b.split()
            cut = draw.randrange(len(tokens))
            b = " ".join(tokens[cut:] + tokens[:cut])  # the same shingles in another order
        (x, y), _ = near_dedup.sequences([a.encode(), b.encode()])
        common = longest_common(x.tolist(), y.tolist())
        want = 10 * common >= 8 * (len(x) + len(y) - common)
        assert near_dedup.linked(x, y) == want
        seen[want] += 1
    assert min(seen.values()) > 20


def test_classes_lose_no_link(spark):
    draw = random.Random(7)
    docs = []
    for g in range(40):
        text = words(draw.randrange(5, 260), 1000 * g)
        docs.append(text)
        docs += [edited(text, draw.choice([0.004, 0.01, 0.02, 0.04]), draw) for _ in range(6)]
    passage = words(60, 77)
    docs += [passage + " " + words(90, 50_000 + 100 * i) for i in range(60)]  # shared, but no duplicates
    centre = words(300, 9)
    docs += [centre] + [edited(centre, 0.03, draw) for _ in range(80)]
    frame = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(docs)])
    got = {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()}
    sequences, _ = near_dedup.sequences([t.encode() for t in docs])
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if near_dedup.linked(sequences[i], sequences[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(docs))}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 3)]
    got = dict(rows(components(spark.createDataFrame(chain, "x long, y long"))))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# --- pieces -------------------------------------------------------------------------------------
PIECE_TEXTS = [t for t in TEXTS if len(t) < 3000] + [
    "a▁b ￿ ▁▁ x", "a" * 1500, " lead", "trail  ", "\x00\n\n  x   ", "Hello world, hello words!", "thereisnospaceinthis" * 40]


@pytest.fixture(scope="module")
def voc():
    return pieces.Vocabulary(pieces.read_model())


def test_plans_give_the_best_sum(voc):
    for text in PIECE_TEXTS:
        if not text:
            continue
        ids = pieces.encode_all(voc, [pieces.plan(voc, pieces.normal(text), pieces.source_of(text))])[0]
        assert pieces.decode_ids(voc, ids) == text.encode()
        if pieces.MASK not in pieces.normal(text):
            assert ids.tolist() == pieces.searched(voc, pieces.normal(text))


def test_chunks_combine_to_the_whole(voc):
    draw = random.Random(8)
    for text in [t for t in PIECE_TEXTS if len(t) > 200 and pieces.MASK not in pieces.normal(t)]:
        whole = pieces.normal(text)
        want = pieces.searched(voc, whole)
        for _ in range(6):
            at = [0, *sorted(draw.sample(range(60, len(whole) - 60, 40), 2)), len(whole)]
            cells = [pieces.transfer(voc, ("" if a else "\0") + whole[max(a - 1, 0):b + voc.longest], b - a)
                     for a, b in zip(at, at[1:])]
            assert pieces.product([pieces.product(cells[:2]), cells[2]]) == pieces.product(cells)  # associative
            states = pieces.route(cells, 0, 0)
            ids = [i for (a, b), s, t in zip(zip(at, at[1:]), states, states[1:])
                   for i in pieces.encode_all(voc, [pieces.plan(voc, whole[a + s:b + t])])[0].tolist()]
            assert voc.scores[ids].sum() == voc.scores[want].sum()
            assert pieces.decode_ids(voc, ids) == text.encode()


def test_giant_texts_through_the_tree(spark, voc, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", 300)
    monkeypatch.setattr(pieces, "FAN", 3)
    docs = documents(spark, ODD + [(20, "nospace" * 900, "en", "a", 1), (21, LONG, "en", "b", 1)])
    got = {r.doc_id: r for r in pieces.encode(docs, giant=600).collect() if r.doc_id}
    assert all(r.round_trip for r in got.values()) and len(got) == len({d[0] for d in ODD if d[0]}) + 2
    for doc_id, text in ((6, LONG), (20, "nospace" * 900), (7, "x" * 60_000)):
        want = pieces.encode_all(voc, [pieces.plan(voc, pieces.normal(text))])[0]
        assert voc.scores[got[doc_id].ids].sum() == voc.scores[want].sum()
    assert got[6].ids == got[21].ids and got[3].ids == got[4].ids == []
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect() if r.doc_id}
    assert back == {d[0]: d[1] or "" for d in ODD if d[0]} | {20: "nospace" * 900, 21: LONG}


def unspaced(seed, n, letters):
    draw = random.Random(seed)
    return "".join(draw.choice(letters) for _ in range(n))


@pytest.mark.parametrize("text", ["x" * 700, "nospace" * 100, "aaab" * 200, *[unspaced(s, 700, "ab") for s in range(6)],
                                  *[unspaced(s, 700, "etaoinshr") for s in range(6)]])
def test_open_cuts_change_no_identifier(voc, text):
    whole = pieces.normal(text)
    want = pieces.searched(voc, whole)
    draw = random.Random(len(set(text)))
    for n in (1, 3, 8, 40):
        at = [0, *sorted(draw.sample(range(1, len(whole) - 1), n)), len(whole)]
        cells = [pieces.transfer(voc, ("" if a else "\0") + whole[max(a - 1, 0):b + voc.longest], b - a)
                 for a, b in zip(at, at[1:])]
        half = len(cells) // 2
        for groups in ([cells], [cells[:half], cells[half:]]):
            middle = pieces.route([pieces.product(g) for g in groups], 0, 0)
            states = [0]
            for g, s, t in zip(groups, middle, middle[1:]):
                states += pieces.route(g, s, t)[1:]
            spans = [(a + s, b + t) for a, b, s, t in zip(at, at[1:], states, states[1:])]
            assert [i for a, b in spans for i in pieces.searched(voc, whole[a:b])] == want


def test_giant_texts_have_the_identifiers_of_small_ones(spark, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", 300)
    monkeypatch.setattr(pieces, "FAN", 3)
    texts = ["nospace" * 900, "x" * 6000, LONG[:9000], *[unspaced(s, 6000, "etaoinshr") for s in range(4)]]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    large, small = ({r.doc_id: r.ids for r in pieces.encode(docs, giant=g).collect()} for g in (600, 10**6))
    assert large == small


# --- odd inputs -------------------------------------------------------------------------------------
def _labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 1), (None, 1, 1), (9, 0, 1), (10, None, None)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "quality": lambda docs, labels: quality_crf.judge(docs, labels),
    "near": lambda docs, labels: near_dedup.classes(docs),
    "rules": lambda docs, labels: rules_forest.judge(docs, labels),
    "licences": lambda docs, labels: license_scan.scan(docs),
    "pieces": lambda docs, labels: pieces.encode(docs),
    "toxicity": lambda docs, labels: toxicity.judge(docs, labels),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    labels = _labels(spark)
    for chosen in (labels, labels.limit(0)):
        got = OPERATORS[name](with_clashes(spark), chosen).collect()
        assert Counter(r.doc_id for r in got) == Counter(d[0] for d in ODD)
    assert OPERATORS[name](with_clashes(spark, []), labels).collect() == []


def test_odd_rows_near(spark):
    got = near_dedup.classes(documents(spark)).collect()
    of = {r.doc_id: r for r in got if r.doc_id}
    assert of[1].class_id == of[2].class_id == of[9].class_id == of[10].class_id == 1
    assert of[3].class_id == of[4].class_id == of[5].class_id == 3
    assert Counter(r.class_id for r in got if r.kept) == Counter({r.class_id for r in got})
    kept = near_dedup.kept_rows(with_clashes(spark))
    assert kept.columns == with_clashes(spark).columns and kept.count() == len({r.class_id for r in got})


def test_slices_keep_rows(spark):
    import pyarrow as pa

    batch = pa.record_batch({"text": ["a", None, "é"], "n": pa.array([1, None, 2 ** 60])})
    parts = list(slices(batch, "text"))
    assert [t for _, texts in parts for t in texts] == [b"a", b"", "é".encode()]
    assert pa.Table.from_batches([p for p, _ in parts]).to_pydict() == batch.to_pydict()


# --- hashes ---------------------------------------------------------------------------------
def twins(n):
    """A Thue-Morse text of the letters a and b, and the one with the letters exchanged: equal under any polynomial modulo 2^64."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 128, 1024, 2048, 8192])
def test_twins_are_told_apart(spark, n):
    from dockflow.llm.wordgrid import ALNUM, Words, span_hash

    one, two = twins(n)
    grid = Words([f"{one} {two} {one}".encode()], ALNUM)
    a, b, c = span_hash(grid.buffer, grid.start, grid.end)
    assert a == c != b
    lines = f"{one}\n{two}\n{one} x\n{two} x\n{one}"
    stats = rules_forest.statistics([lines.encode(), f"{one} m n {two} m n".encode()])
    assert stats["n_dup_lines"].tolist() == [1, 0] and stats["n_repeat_words"].tolist() == [0, 0]
    got = near_dedup.classes(documents(spark, [(1, one, "en", "a", 1), (2, two, "en", "a", 1), (3, one, "en", "a", 1)])).collect()
    assert len({r.class_id for r in got}) == 2


def test_ids_hold_where_hashes_do_not(monkeypatch):
    from dockflow.llm import wordgrid

    spans = [b"one", b"two", b"three", b"one", b"", b"two", b"six", b"x" * 300, b"x" * 300, b"y" + b"x" * 299]
    buffer = np.frombuffer(b"".join(spans), np.uint8)
    end = np.cumsum([len(s) for s in spans])
    start = end - [len(s) for s in spans]
    for weak in (None, 1, 3):
        if weak:
            monkeypatch.setattr(wordgrid, "span_hash", lambda b, s, e: ((e - s) % weak).astype(np.uint64))
        ids = wordgrid.span_ids(buffer, start, end).tolist()
        assert [[a == b for b in ids] for a in ids] == [[a == b for b in spans] for a in spans]
