"""Every generator has labels and a threshold of its own."""

import random

from llm import pii


def test_numbers_addresses_and_passwords_beyond_the_strict_forms(spark):
    rng = random.Random(5)
    n = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    rows = []
    for i in range(400):
        name = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 14)))
        parts = [f"dial +49 {n(3)} {n(7)} now", f"phone {n(3)}-{n(4)} now", f"her ssn {n(3)}-{n(2)}-{n(4)} too", f"item {n(3)}-{n(4)} of {n(3)} {n(2)} {n(4)}", f"write to {name}@{name[::-1]}.de please", f"on 2024-0{n(1)}-1{n(1)} we met", f"see {name}@{name} and @home", "password: required"]
        rows.append((i, " and ".join([rng.choice(parts), f"password={rng.choice(['Summer', 'hunter'])}{n(2)}"])))
    new = ["my social security number is 123-45-6789 here", "write to j\u00fcrgen@ex\u00e4mple.de please", "password=hunter2 was it", "password=aBcDefGh was it", "on 2024-03-17 we met", "password: required"]
    df = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(new)], "doc_id long, text string")
    found = pii.redact(pii.find(df, pii.train(df))).where("doc_id >= 1000").orderBy("doc_id").collect()
    assert [r.text for r in found] == ["my social security number is [SECRET] here", "write to [SECRET] please", "[SECRET] was it", "[SECRET] was it", *new[4:]]
