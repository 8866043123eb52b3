import random
import string

import pytest

from claimbrook.llm import secrets

RNG = random.Random(5)
draw = lambda chars, n: "".join(RNG.choice(chars) for _ in range(n))
KEYS = {
    "letters": draw(string.ascii_letters, 40),
    "lower": draw(string.ascii_lowercase, 40),
    "upper": draw(string.ascii_uppercase, 40),
    "digits": draw(string.digits, 40),
    "grouped digits": "-".join(draw(string.digits, 4) for _ in range(10)),
    "grouped letters": "-".join(draw(string.ascii_letters, 8) for _ in range(5)),
    "upper hex": draw("0123456789ABCDEF", 40),
    "mixed": draw(string.ascii_letters + string.digits, 40),
    "digits in a path": "path/of/" + draw(string.digits, 40),
    "after example": "docs/example/" + draw(string.ascii_letters + string.digits, 40),
    "after xxxx": "xxxx-0123456789-" + draw(string.ascii_letters, 40),
}
PLAIN = [
    "some/longer/path-with_ordinary-words/and-more",
    "internationalization_und-Rechtsschutzversicherungsgesellschaften",
    "getElementsByTagNameFromDocumentFragmentList",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "123e4567-e89b-12d3-a456-426614174000",
    "00000000000000000000000000000000",
    "2024-01-01/2024-02-01-2024-03-01",
    "=" * 60,
    "YOUR_PLACEHOLDER_GOES_EXACTLY_HERE",
]


@pytest.fixture(scope="module")
def spans(spark):
    rows = [(k, f"see {k} here") for k in PLAIN] + [(n, f"ab {k} cd") for n, k in KEYS.items()]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(df)).collect()}


@pytest.mark.parametrize("name", KEYS)
def test_random_keys_are_found(spans, name):
    # Bare digits are named by the hex pattern before entropy is asked.
    kind = "hex" if name == "digits" else "entropy"
    assert f"{kind}:3:{3 + len(KEYS[name])}" in spans[name]


@pytest.mark.parametrize("text", PLAIN)
def test_words_and_sequences_are_not(spans, text):
    assert "entropy" not in spans[text]
