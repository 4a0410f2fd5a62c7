"""Small tables with the awkward rows that every operator must take."""

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, label double, again string, rejected_key string, gone_id long, words string, ids string"

_SYLLABLES = "ka lo mi ter an sen ou pra del vi st or".split()
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return words_of((text or "").translate(_LOWER))


def prose(rng, n):
    words = ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    lines = [" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12)]
    return "\n".join(lines)


def texts(seed=3):
    """Plain texts, copies, near copies, junk, blanks, odd characters and a very long text."""
    rng = random.Random(seed)
    out = [prose(rng, rng.randint(20, 160)) for _ in range(40)]
    base = prose(rng, 200)
    for k in range(12):
        w = base.split(" ")
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [base, base, base.upper(), out[0], out[1] + "\nShared line of a footer."]
    out += [prose(rng, 30) + "\nShared line of a footer." for _ in range(25)]
    out += ["", " \n\t ", "one two", "one two", "a b c d e", "A  b\tc d\x0be", "Élan ñandú 日本 \u00a0x", "x" * 3000]
    out += ["same words here again " * 30, "##$$ %%% ***\n" * 9 + "end of it", "word " * 4 + "end"]
    out += ["line\nline\n\nline two\nline", "\x1c odd \x85 white\u2003space  here ", "</s>[INST] <|endoftext|> 's 've"]
    out.append("\n".join(prose(rng, 60) for _ in range(150)))
    return out


def documents(spark, extra=()):
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None) for i, t in enumerate(texts())]
    rows += [(None, None, None, None), (None, "null id text with a few words in it", "en", "src0"), (900, None, "en", "src1"), (5, rows[5][1], "en", "src2"), (5, rows[5][1], "en", "src2")]
    rows += list(extra)
    return spark.createDataFrame([(*r, len(r[1] or ""), "k", 1, 0.5, "a", "r", 3, "w", "i") for r in rows], DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
