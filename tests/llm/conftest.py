"""A small table with everything awkward in it: nulls, empty and long texts, repeats, ties, clashing column names."""

import random

import pytest

SYLLABLES = "the an er on in ing ti re at es ou ha tion ly ed".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
        out.append(w + (".\n" if i % 17 == 16 else "," if i % 7 == 6 else ""))
    return " ".join(out).replace("\n ", "\n")


def edited(text: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


@pytest.fixture(scope="session")
def texts():
    base = prose(1, 300)
    out = {0: base, 1: base, 2: edited(base, 5, 3), 3: edited(base, 6, 40), 4: prose(2, 40), 5: None, 6: "", 7: "  \n\t ", 8: "one two three", 9: "one two three", 10: "The end.", 11: prose(3, 9000)}
    out |= {12: "a  b   c\n\n\nd \n e\t\tf ünï 中文 🎉 don't 's x" + "y" * 500, 13: ("repeat after me now please my good friend " * 6).strip(), 14: "123 456 ### $$$", 15: "é" * 40}
    out |= {20 + i: prose(100 + i, 30 + 11 * i) for i in range(20)}
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(k, t, ["en", "fr", None][k % 3], ["a", "b", None, "c"][k % 4], 1, 0.5, "x", 3) for k, t in texts.items()]
    rows += [rows[0], rows[4], (None, texts[4], "en", "a", 1, 0.5, "x", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, block string, size long"
    return spark.createDataFrame(rows, schema).repartition(3)
