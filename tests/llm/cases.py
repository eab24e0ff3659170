"""Documents with nulls, empty and long texts, ties, repeated rows and clashing names."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, spans string, size long"
LINE = "a line of more than forty characters, seen in many documents of the table"


def rows() -> list[tuple]:
    word = [f"word{i}" for i in range(60)]
    plain = " ".join(word)
    texts = [
        (1, plain),
        (2, plain),
        (3, plain.replace("word59", "other")),
        (3, " ".join(word[::-1])),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (None, plain + "\nand one more"),
        (None, None),
        (7, "Password: 'abcdefgh12' token=short AKIA" + "A1" * 10 + " " + "0123456789abcdef" * 3),
        (8, "x " * 30000),
        (9, " ".join(f"w{i % 977}" for i in range(20000)) + "\r\n  end  of   it"),
        (10, "É ß \x01 <|endoftext|> 😀 secret = ÄÄ secret:abcdefghi\x1c"),
        (11, "one"),
        (11, "one"),
    ]
    texts += [(20 + i, f"{LINE}\nown words {i} of this text\n  {LINE.upper()} ") for i in range(6)]
    texts += [(30, "x"), (30, "x")]
    return [(d, t, "en" if d and d % 2 else None, "s", len(t or ""), "r", None, 0) for d, t in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
