"""Small documents with the awkward cases every operator has to bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, kept string, spans string"


def awkward(seed=0, n=40, alphabet=("ab", "cd", "ef", "GH", "ü", "x1")):
    pick = random.Random(seed)
    texts = []
    for k in range(n):
        if texts and k % 3 == 0:
            base = pick.choice(texts).split(" ")
            at = pick.randrange(len(base) + 1)
            texts.append(" ".join(base[:at] + [pick.choice(alphabet)] + base[at:]))
        elif texts and k % 5 == 0:
            texts.append(pick.choice(texts))
        else:
            texts.append(" ".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 30))))
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (None, texts[0]), (3, texts[3]), (3, texts[3]), (n + 3, " ".join(texts) * 20)]
    pick.shuffle(rows)
    return rows


def frame(spark, rows):
    """Documents with further columns named like columns that operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "kept", "x") for i, t in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
