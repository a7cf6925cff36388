"""Documents with every awkward case, shared by the tests."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, ids string, _h1 int, bucket int, _score int"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple]:
    long = words(30_000, 1)
    texts = [
        None, "", "   ", "\n\n", "one", "one two three four", words(300, 2), words(300, 2), words(300, 3), long, long + " x",
        "x" * 20_000, "tab\tand space  two \n three", "日本語のテキスト 漢字 text", "<|endoftext|> <|im_end|>\n<|im_start|>", "😀 \x00 \x1c",
    ]
    out = [(i, t, "en", f"s{i % 3}", len(t or ""), "k", "clash", 1, 2, 3) for i, t in enumerate(texts)]
    out += [out[6], out[0]]  # repeated rows
    out += [(None, "a null key", None, None, None, None, None, None, None, None), (50, words(300, 2), None, None, None, None, None, None, None, None)]
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)
