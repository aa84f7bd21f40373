"""Documents with every edge: nulls, empties, copies, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
EXTRA = ", size long, score double, row long, key long, bucket long, taken long, base string, added string"
BLANK = (None,) * 8


def edge_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]

    def prose(n: int) -> str:
        return " ".join(rng.choices(vocab, k=n)).capitalize() + "."

    long = "\n".join(prose(40) for _ in range(100))
    passage = prose(60)
    texts = [prose(rng.randint(3, 120)) for _ in range(30)]
    texts += [None, "", " \n\t", "é😀", "x", long, long, long + " " + vocab[0]]
    texts += [f"{prose(10)}\n{passage}\n{prose(12)}" for _ in range(6)]
    texts += ["Der " * 400, "to%%% the*** of### " * 40, passage, passage]
    texts += ["mail a.b@c.example.com or +1 (555) 010-7712, host 10.0.0.1, card 4111 1111 1111 1111."]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    rows.append((None, texts[3], None, None, None))
    rows.append((None, texts[4], None, "src0", None))
    return rows


def documents(spark, rows=None, extra: bool = True):
    rows = edge_rows() if rows is None else rows
    if extra:
        return spark.createDataFrame([(*r, *BLANK) for r in rows], SCHEMA + EXTRA)
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, rows=None):
    if rows is None:
        rows = [(i, i % 4 != 0, False) for i in range(40)] + [(2, None, None), (None, True, False), (3, False, True)]
    return spark.createDataFrame(
        [(i, None if q is None else int(q), None if t is None else int(t)) for i, q, t in rows],
        "doc_id long, quality int, toxic int",
    )
