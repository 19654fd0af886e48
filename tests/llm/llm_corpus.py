"""The hard cases that every operator is tested on."""

import random

from pyspark.sql import types as T

#: Columns with names that the operators use themselves.
CLASHING = "block string, shard string, row string, rid string, spans string, key string, length string, words string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def corpus():
    """Texts with copies, near copies, passages, personal data and licenses; ids repeat, texts are null, empty or very long."""
    rng = random.Random(5)
    passage = " ".join(words(rng, 70))
    base = words(rng, 200)
    near = list(base)
    near[100] = "changed"
    far = [w if i % 9 else "other" for i, w in enumerate(base)]
    texts = [" ".join(words(rng, rng.choice((3, 15, 60, 150)))) for _ in range(12)]
    texts += [" ".join(base), " ".join(base), " ".join(near), " ".join(far), " ".join(near[1:])]
    texts += [" ".join(words(rng, 30)) + f"\n{passage}\n" + " ".join(words(rng, 30)) for _ in range(4)]
    texts += ["Mail a.b@c.org or x@y.z@w.com, call +1 (234) 567-8901 from 10.0.0.255 or 1.2.3.256.", "4111 1111-1111 1111 and 4111111111111112 +12 3"]
    texts += ["This is under the MIT  License.\nLicensed under the Apache License, Version 2.0.\nMIT license", "K Mit-LICENSE mitlicense license"]
    texts += ["the same line\nthe same line\n\n \n#$%", "one two three", "one two three", "ONE two three", "ä ö ü 東京 שלום é", "\x00a\x1cb\x85c d"]
    texts += [None, None, "", " \n\t", "a" * 50_000, "1" * 30_000, " ".join(["again"] * 20_000), "<|endoftext|> it's <|ENDOFTEXT|>don't.,!"]
    return texts


def frame(spark, rows, schema=DOCUMENTS):
    width = len(T.StructType.fromDDL(schema).fields)
    return spark.createDataFrame([(*r, *["clash"] * (width - len(r))) for r in rows], schema)
