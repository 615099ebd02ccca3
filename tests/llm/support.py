"""Documents with everything that may go wrong, and plain versions of the operators."""

import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORDS = "alpha beta gamma delta omega über naïve ça straße 東京 kilo lima mike nova oscar".split()

# Names that the operators use inside; the tables' own columns of these names must not matter.
CLASHES = (
    "id row chunk ids sizes body rest rank part key size shard slot label dims cell n h1 score links "
    "block start length offset held_out predicted fingerprint n_chars n_words toxic region answers"
).split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def hard_texts(seed=1):
    """Copies, near copies, shared passages, lines said often, long, short, blank and no texts."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    base = sentence(rng, 120)
    out = [None, "", " \t\n", "one", "one", "two words", base, base]
    for _ in range(12):
        words = base.split(" ")
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(1000))
        out.append(" ".join(words))
    for _ in range(6):
        out.append(sentence(rng, rng.randrange(5, 90)) + "\n" + passage + "  " + sentence(rng, 20))
    out.append("same line here again\n" * 80)
    out.append("%" * 5000)
    out.append(sentence(rng, 6000))
    out.append("ab" * 30_000)
    out += [sentence(rng, rng.randrange(1, 200)) for _ in range(25)]
    return out


def table(spark, rows, text_type=None):
    """(doc_id, text) with more columns, whose names clash with those inside the operators."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", text_type or T.StringType()),
            *(T.StructField(c, T.StringType()) for c in CLASHES),
        ]
    )
    full = [(k, t, *(f"{c}{i}" if i % 3 else None for c in CLASHES)) for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def hard_documents(seed=1):
    rows = list(enumerate(hard_texts(seed), start=3))
    random.Random(seed).shuffle(rows)
    return rows


def roots(names, links):
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in names}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_links(rows, k, num, den):
    sets = [(key, shingles(text, k)) for key, text in rows]
    return [
        (a, b)
        for i, (a, s) in enumerate(sets)
        for b, t in sets[:i]
        if s and t and den * len(s & t) >= num * len(s | t)
    ]


def removed_bytes(rows, width=50):
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            s = data[i : i + width]
            first[s] = min(first.get(s, key), key)
    out = {}
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < key:
                gone[i : i + width] = b"\1" * width
        out[key] = data, gone
    return out


def removed_words(rows, width=35):
    count = Counter()
    for _, text in rows:
        words = (text or "").encode().split()
        count.update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    out = defaultdict(list)
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if count[tuple(words[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out[key].append((words, gone))
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
