"""Awkward documents for the tests of this folder."""

import random

# columns whose names the operators use themselves, to see that nothing clashes
CLASH = "k1 k2 h n fp key sid token c y score hits x wanted starts ends __k1__ word lang2 root least component_id".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def rows(texts):
    """Rows from (doc_id, text) pairs."""
    return [(i, t, "en" if (i or 0) % 2 else None, "src", len(t) if t else None, *["z"] * len(CLASH)) for i, t in texts]


def awkward(seed=1, vocabulary=6, n=30, longest=60):
    """Random texts over few words, with copies, shared passages, nulls, empty, long and periodic texts."""
    rng = random.Random(seed)
    words = ["a", "Bb", "ccc", "é", "日本", "x.", "dd", "e"][:vocabulary]
    make = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = make(20)
    texts = [make(rng.randint(0, longest)) for _ in range(n)]
    texts += [texts[0], texts[1] + " " + passage, passage + "\n" + texts[2], texts[3].replace(" ", "\t\n "), "a " * 80, "   \n", "", "Bb"]
    texts.append(" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(3000)) + " " + passage)
    out = list(enumerate(texts)) + [(None, None), (None, texts[4]), (len(texts), None), (0, texts[0]), (0, texts[5])]
    rng.shuffle(out)
    return out
