"""Texts for the tests of the text operators."""
import random

SYLLABLES = "an er in on th re st ou ha to ed ing ble tion es or ly sh wh ea".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    out, line = [], []
    for w in words:
        line.append(w + rng.choice(["", "", "", "", ",", "."]))
        if len(line) > 18:
            out.append(" ".join(line).capitalize())
            line = []
    return "\n".join([*out, " ".join(line)])


def edited(text: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randint(0, 999)}y"
    return " ".join(words)


def rows():
    """(doc_id, text, lang, source, n_chars) with every odd case."""
    passage = prose(900, 70)
    base = [(i, prose(i, 60 + 13 * i)) for i in range(24)]
    base += [(100 + i, edited(base[20][1], i, 3)) for i in range(6)]  # near copies
    base += [(200 + i, base[3][1]) for i in range(4)]  # exact copies
    base += [(300 + i, prose(50 + i, 90) + "\n" + passage + "\n" + prose(70 + i, 80)) for i in range(3)]  # a shared passage
    base += [(400, prose(7, 100) + " you stupid trash and moron"), (401, "word " * 300), (402, "a | b # c $ " * 60),
             (403, "Released under the MIT License.\n" + prose(8, 60)), (404, prose(9, 9000)), (405, "one two three"),
             (406, "<|endoftext|> <s> İstanbul é́ 日本語 😀\t\x00x  y \n\n z"), (407, " "), (408, ""), (409, None), (410, "▁ a ▁")]
    out = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}" if i % 5 else None, len(t) if t is not None else None) for i, t in base]
    out += [(None, prose(11, 120), "en", "src1", 5), (None, None, None, None, None), (None, base[5][1], "en", None, 1)]
    out += [out[6], out[6], (7, prose(77, 70), "en", "src0", 3)]  # a row repeated, a doc_id repeated with another text
    return out


def doubled(n: int = 11) -> tuple[str, str]:
    """Two different words of 2^n letters that any polynomial hash modulo 2^64 takes for one: abba baab ... and its mirror."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b
