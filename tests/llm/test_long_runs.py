from claimbrook.llm import toxicity


def test_every_character_of_a_run_is_read():
    run = "".join(chr(0x4E00 + i) for i in range(1000))
    for n in (1, 63, 64, 65, 66, 67, 126, 127, 1000):
        words = toxicity.words_of(f"ab {run[:n]} cd")
        assert words[0] == "ab" and words[-1] == "cd" and max(map(len, words)) <= 64
        assert words[1] + "".join(w[2:] for w in words[2:-1]) == run[:n]


def test_the_end_of_a_run_reaches_the_score():
    rows = [(f"good calm day {i}", 0) for i in range(30)] + [(f"vile foul slur {i}", 1) for i in range(30)]
    model = toxicity.train(rows)
    start = "good" * 40
    clean, toxic = toxicity.score_texts(model, [start + "calm" * 40, start + "foul" * 40])
    assert toxic > clean
