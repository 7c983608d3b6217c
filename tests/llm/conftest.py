import random

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns whose names clash with internal ones."""

    def make(pairs):
        rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 1, "x", None) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, rid long, body string, row string"
        ).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, odd bytes, empty and null ones."""
    r = random.Random(7)
    vocabulary = ["".join(r.choices("abcdeé", k=r.randint(1, 7))) for _ in range(400)]

    def prose(n):
        words = [r.choice(vocabulary) + r.choice(["", "", ",", ".", "\n"]) for _ in range(n)]
        return " ".join(w.capitalize() if r.random() < 0.1 else w for w in words)

    passage, line = prose(60), "A line that many documents hold, word for word."
    texts = [prose(r.randint(1, 150)) for _ in range(30)]
    texts += [prose(20) + " " + passage + " " + prose(20) for _ in range(8)]
    texts += [t + "\n" + line for t in texts[:12]] + texts[3:9]
    for t in texts[30:36] + texts[10:14]:
        words = t.split(" ")
        for _ in range(max(1, len(words) // 30)):
            words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += ["", None, "\n\n", "one", "two words", "a b c d", "x" * 900, "ab" * 300, "é" * 250, " \t ", passage * 40]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def odd_corpus(corpus):
    """The same with repeated rows, repeated ids and null ids."""
    return corpus[:20] + corpus[2:5] + [(5, corpus[9][1]), (None, corpus[11][1]), (None, None), (None, corpus[11][1])] + corpus[-11:]
