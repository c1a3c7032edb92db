import random

import plain
import pytest

from waymark.llm.license_scan import NOTICES, PHRASES, scan_licenses


def places(text):
    own, found = plain.words(text), []
    for phrase, label in PHRASES:
        there = phrase.split()
        found += [(s, label) for s in range(len(own) - len(there) + 1)
                  if own[s : s + len(there)] == there]
    return len(own), found


@pytest.mark.parametrize("given", ["odd", "corpus", "made"])
def test_base_places_equal_brute_force(spark, given):
    rows = plain.ODD
    if given == "corpus":
        rows = [tuple(r) for r in plain.corpus(spark).collect()]
    if given == "made":
        rows = [(n, t, None, None, None) for n, t in enumerate([
            "MIT License", "the mit, license. cc-by CC BY cc by cc", "apache   license " * 3,
            "GNU General Public\nLicense gnu general public", "mit licenses", "Émit license",
            "w " * 20_000 + "apache license", "license mit", "gnu gnu general public license",
        ])]
    found = scan_licenses(plain.documents(spark, rows)).collect()
    expected = []
    for r in rows:
        n, there = places(r[1])
        starts = [s for s, _ in there]
        expected.append(str((
            r[0], n, len(there), min(starts, default=None), max(starts, default=None),
            sorted({label for _, label in there}),
        )))
    assert sorted(
        str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
        for r in found
    ) == sorted(expected)
    for r in found:
        assert 0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels)
        assert r.score == 1 or not r.n_base


def test_notices_are_found_though_words_are_left_out_or_put_in(spark):
    text = dict(NOTICES)["mit-notice"]
    own = text.split()
    edited = own[:20] + ["very", "much"] + own[20:45] + own[47:]
    rows = [
        (1, text, None, None, None), (2, "before " * 30 + " ".join(edited) + " after", None, None, None),
        (3, " ".join(own[:14]), None, None, None), (4, " ".join(reversed(own)), None, None, None),
        (5, " ".join(own[30:] + own[:30]), None, None, None),
    ]
    found = {r.doc_id: r for r in scan_licenses(plain.documents(spark, rows)).collect()}
    assert found[1].labels == ["mit-notice"] and found[1].score == 1
    assert found[2].labels == ["mit-notice"] and 0.6 <= found[2].score < 1
    assert found[3].labels == [] and 0 < found[3].score < 0.6
    assert (found[4].labels, found[4].score) == ([], 0)
    assert all(r.n_base == 0 for r in found.values())


def spans(text, gram=5, drift=4, gap=64):
    """Of each notice the parts of its words in its spans, by the definition: all equal k-grams,
    runs of near diagonals, and runs that go on in both texts."""
    own = plain.words(text)
    found = {}
    for label, notice in NOTICES:
        there = plain.words(notice)
        at = {}
        for a in range(len(there) - gram + 1):
            for p in range(len(own) - gram + 1):
                if own[p : p + gram] == there[a : a + gram]:
                    at.setdefault(p - a, set()).add(a)
        runs, last = [], None
        for d in sorted(at):
            if last is None or d - last > drift:
                runs.append([])
            runs[-1].append(d)
            last = d
        placed = sorted(
            (min(d + min(at[d]) for d in run), n, max(d + max(at[d]) + gram for d in run),
             set().union(*(at[d] for d in run)))
            for n, run in enumerate(runs, 1)
        )
        chains = []
        for start, _, end, voted in placed:
            if chains and -gram <= start - chains[-1][0] <= gap and min(voted) > max(chains[-1][1]):
                chains[-1] = (end, voted, chains[-1][2] | voted)
            else:
                chains.append((end, voted, set(voted)))
        for _, _, voted in chains:
            part = len({a + i for a in voted for i in range(gram)}) / len(there)
            found[label] = max(found.get(label, 0), part)
    return found


def test_labels_and_scores_equal_brute_force(spark):
    dice = random.Random(6)
    texts = []
    for n in range(60):
        words = []
        for _ in range(dice.randrange(1, 4)):
            notice = dice.choice(NOTICES)[1].split()
            for _ in range(dice.randrange(4)):
                at = dice.randrange(len(notice))
                if dice.random() < 0.6:
                    notice[at:at] = ["put"] * dice.choice([1, 3, 5, 30, 80])
                else:
                    del notice[at : at + dice.choice([1, 2, 8])]
            words += ["between"] * dice.randrange(40) + notice
        texts.append((n, " ".join(words), None, None, None))
    found = {r.doc_id: r for r in scan_licenses(plain.documents(spark, texts)).collect()}
    for n, text, *_ in texts:
        parts = spans(text)
        known = {label for label, part in parts.items() if part >= 0.6}
        assert set(found[n].labels) == known | set(found[n].base_labels)
        if not found[n].n_base:
            assert found[n].score == pytest.approx(max(parts.values(), default=0))


def test_a_whole_notice_with_words_put_in_its_middle_keeps_its_label(spark):
    rows = []
    for n, (_, notice) in enumerate(NOTICES):
        own = notice.split()
        half = len(own) // 2
        rows.append((n, " ".join([*own[:half], *["page", "header"] * 10, *own[half:]]), None, None, None))
    found = {r.doc_id: r for r in scan_licenses(plain.documents(spark, rows)).collect()}
    assert all(label in found[n].labels for n, (label, _) in enumerate(NOTICES))


def test_plan_is_native_and_empty_table(spark):
    assert scan_licenses(plain.empty(spark)).count() == 0
    plan = scan_licenses(plain.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Cartesian", "NestedLoop"))
