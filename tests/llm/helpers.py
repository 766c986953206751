"""Small tables and brute-force versions for the tests of the corpus operators."""

import random
import re
import uuid

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def write(spark, folder, **frames):
    """A folder of tables, as the queries read them."""
    path = f"{folder}/{uuid.uuid4().hex}"
    for name, df in frames.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path


def prose(seed, n, vocabulary=4000):
    """``n`` invented words."""
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def links_and_classes(docs, tenths=8):
    """{row number: (least linked id, number of links)} over all pairs of rows."""
    sets = [shingles(t) if d is not None else frozenset() for d, t in docs]
    parent, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 10 * both >= tenths * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(least.get(find(i)) if docs[i][0] is not None else None, links[i]) for i in range(len(docs))]


def removed_words(docs, window=13):
    """Kept words of each row after taking out windows that a smaller id has."""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out
