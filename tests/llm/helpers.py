"""Small corpora with nulls, empty texts, copies, shared passages and odd characters."""

import random
import re

SPACE = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STEMS = "lo re mi fa so la ti do en er al un is at or ée ño öx".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def word(rng):
    return "".join(rng.choice(STEMS) for _ in range(rng.randint(1, 3)))


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(word(rng))
        out.append(rng.choice([" ", " ", " ", ". ", "\n", "  ", "\t", ", "]))
    return "".join(out).capitalize()


def corpus(seed=1, n=60):
    """(doc_id, text) rows; ids are not in order and start above zero."""
    rng = random.Random(seed)
    passages = [prose(rng, 60) for _ in range(3)]
    rows = [None, "", " \n\t", "one", "two words", "a b c", "A b C", "x " * 50, "Der " * 200, prose(rng, 3000)]
    for _ in range(n):
        rows.append(prose(rng, rng.randint(5, 160)))
    for _ in range(12):
        rows.append(prose(rng, rng.randint(0, 30)) + " " + rng.choice(passages) + " " + prose(rng, rng.randint(0, 30)))
    base = prose(rng, 150)
    for _ in range(10):
        parts = re.split("( )", base)
        for _ in range(rng.randint(0, 5)):
            parts[2 * rng.randrange(len(parts) // 2)] = word(rng)
        rows.append("".join(parts))
    rows += [base, base, base, rows[12], rows[13]]
    rng.shuffle(rows)
    return [(1000 + 7 * i, t) for i, t in enumerate(rows)]


def frame(spark, rows):
    """Documents with extra columns, some with names that operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "x", 5, None) for i, t in rows], "doc_id bigint, text string, n_words string, score int, shard string")


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}
