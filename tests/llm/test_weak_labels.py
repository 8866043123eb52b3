"""The labelers of personal data: reliabilities, classifier and spans planted in texts."""

import itertools
import random

import numpy as np

from claimbrook.llm import pii

PLACES = ["Tuesday was calm", "the soup was warm", "nothing else happened", "we walked along"]


def iban(rng):
    body = "".join(rng.choices("0123456789", k=18))
    return f"DE{98 - int(body + '131400') % 97:02d}{body}"


def planted(seed, size):
    """(text, start, end, kind, true): candidates of each kind, personal or not."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choices("23456789", k=n))
    first = (pii.NAMES / "first_names.txt").read_text().split()
    last = (pii.NAMES / "surnames.txt").read_text().split()
    rows = []
    for _ in range(size):
        phone, ssn = f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)}"
        number = f"{rng.choice('ABC')}{digits(7)}"
        name = f"{rng.choice(first).title()} {rng.choice(last).title()}"
        odd = f"{rng.choice(['Golden', 'Silver', 'Broken'])} {rng.choice(['Gate', 'Horse', 'Window'])}"
        street = f"{digits(2)} {rng.choice(['Green', 'Mill', 'Station'])} Road"
        kind, before, match, true = rng.choice(
            [
                ("national_phone", "please call me at ", phone, True),
                ("national_phone", "the order number is ", phone, False),
                ("identity", "my social security number is ", ssn.replace("9", "8", 1) if ssn[0] == "9" else ssn, True),
                ("identity", "see invoice, part ", ssn, False),
                ("account", "pay to the bank account ", iban(rng), True),
                ("account", "model serial ", "AB12" + digits(4) + "CDEF" + digits(4), False),
                ("passport", "my passport is ", number, True),
                ("passport", "the item with sku ", number, False),
                ("name", "yesterday Dr. ", name, True),
                ("name", "they passed the ", odd, False),
                ("street", "she lives at ", street, True),
                ("street", "as in the sample text, item ", street, False),
            ]
        )
        head = f"{rng.choice(PLACES)} and then {before}"
        rows.append((head + match + f", {rng.choice(PLACES)}.", len(head), len(head) + len(match), kind, true))
    return rows


def test_planted_spans_are_found_and_others_left(spark):
    rows = planted(1, 900)
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id int, text string")
    got = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in pii.find_personal_data(df).collect()}
    hits = {kind: [0, 0, 0] for kind in pii.LOOSE}
    for i, (_, start, end, kind, true) in enumerate(rows):
        said = (kind, start, end) in got[i]
        hits[kind][0] += true and said
        hits[kind][1] += true
        hits[kind][2] += said and not true
    for kind, (right, all_, wrong) in hits.items():
        if all_:
            assert right >= 0.9 * all_ and wrong <= 0.05 * all_, (kind, hits)


def test_a_small_table_follows_the_prior(spark):
    rows = [(1, "call 555-223-4567 now"), (2, "order 555-223-4567 now"), (3, None), (4, ""), (1, "call 555-223-4567 now")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r.doc_id, [s.kind for s in r.spans]) for r in pii.find_personal_data(df).collect())
    assert got == [(1, ["national_phone"]), (1, ["national_phone"]), (2, []), (3, []), (4, [])]


def test_reliabilities_match_plain_loops_and_find_the_truth():
    """Votes drawn from known rates: the estimates come near them, and equal plain loops."""
    rng, signs = random.Random(2), [1, 1, 1, -1]
    hit, miss = [0.8, 0.6, 0.4, 0.05], [0.1, 0.2, 0.05, 0.5]
    drawn = {v: 0 for v in itertools.product([0, 1], repeat=4)}
    for _ in range(20000):
        rates = hit if rng.random() < 0.3 else miss
        drawn[tuple(int(rng.random() < r) for r in rates)] += 1
    said, counts = np.array(list(drawn), float), np.array(list(drawn.values()), float)
    post, got_hit, got_miss = pii.reliabilities(said, counts, signs, rounds=200)
    assert np.abs(got_hit - hit).max() < 0.06 and np.abs(got_miss - miss).max() < 0.06

    share = 0.5
    h, m = [pii.PRIOR[s][0] for s in signs], [pii.PRIOR[s][1] for s in signs]
    for _ in range(200):
        plain = []
        for votes in drawn:
            yes, no = share, 1 - share
            for v, a, b in zip(votes, h, m):
                yes, no = yes * (a if v else 1 - a), no * (b if v else 1 - b)
            plain.append(yes / (yes + no))
        mass = sum(p * n for p, n in zip(plain, drawn.values()))
        rest = sum(drawn.values()) - mass
        for j, s in enumerate(signs):
            h[j] = (sum(p * n * v[j] for p, (v, n) in zip(plain, drawn.items())) + 20 * pii.PRIOR[s][0]) / (mass + 20)
            m[j] = (sum((1 - p) * n * v[j] for p, (v, n) in zip(plain, drawn.items())) + 20 * pii.PRIOR[s][1]) / (rest + 20)
        share = (mass + 10) / (mass + rest + 20)
    assert np.allclose(post, plain)


def test_positions_count_code_points(spark):
    text = "ünï 😀 call 555-223-4567 or 555-223-9999"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    spans = pii.find_personal_data(df).first().spans
    assert [text[s.start : s.end] for s in spans] == ["555-223-4567", "555-223-9999"]


def test_phones_with_a_country_code_are_base_spans_only(spark):
    text = "call +1 (555) 223-4567 or (555) 223-4567"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert [(s.kind, s.start) for s in pii.find_personal_data(df).first().spans] == [("phone", 5), ("national_phone", 26)]
