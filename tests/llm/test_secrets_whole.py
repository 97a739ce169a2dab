"""The secret scan's network learns from, and is judged by, the candidates of all documents."""

import random

import numpy as np

from cinderspark.llm import secrets


def test_weights_and_threshold_come_from_all_documents_whatever_the_sample(spark):
    rng = random.Random(6)
    made = []
    for i in range(600):
        w = ["".join(rng.choices(["an", "ter", "ion", "es", "lo", "mi"], k=rng.randint(1, 9))) for _ in range(30)]
        if i % 3 == 0:
            w.insert(rng.randrange(30), f'token = "{rng.getrandbits(160):040x}"')
        made.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    net = secrets.fit_secrets(docs, most_docs=150, most_candidates=100, passes=2)
    seeds = {r["doc_id"]: r["seed"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 9) as seed").collect()}
    learnt, held = 0, []
    for i, t in enumerate(made):
        base = secrets.base_spans(t)
        found = secrets.candidates(t, base)
        others = [(a, b) for a, b, y in found if not y]
        again = [x for u, a, b in secrets.respelled(t, base, others, seeds[i]) for x in secrets.windows(u, a, b)]
        if seeds[i] % 4 == 3:
            held += [(x, y) for a, b, y in found for x in secrets.windows(t, a, b)] + [(x, True) for x in again]
        else:
            learnt += sum(len(secrets.windows(t, a, b)) for a, b, _ in found) + len(again)
    assert (net.learnt, net.judged) == (learnt, len(held)) and learnt > 1000
    x = np.frombuffer(b"".join(x for x, y in held if y), np.uint8).reshape(-1, secrets.WIDE).astype(np.int64)
    p = net.probability(x)
    assert (p >= net.threshold).mean() >= 0.95 and (p > net.threshold + 0.01).mean() < 0.96
