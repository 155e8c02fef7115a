import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from callcredit.llm import alignment
from llm_helpers import docs_of, rng, words  # noqa: F401

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)
ODD = ["▁", "a ▁ b", " ", "  ", "\n", " lead", "trail ", "a  b   c", "tab\t x", "x \ty", "nb sp x y  z", "<s> hi</s> <|endoftext|> <unk> <0x41>",
       "日本語 テキスト 混ぜ", "é É ñ ﬁ ① Å Å", "👩‍👩‍👧 x 🇫🇷", "don't I'll we've 's", "1234567 8.9e10", "\x00 a\x00b \x1c c \x85 d", "q" * 700, "_ __ ___ -- ->", "Ａ１ ｂ",
       "a​b ​ c", "\r\n \r\n x", "http://x.y/z?a=b&c d"]


def brute(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    symbol = alignment.byte_of_symbol()
    raw_a = lambda i: bytes(symbol[c] for c in a.id_to_token(i))
    raw_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    out, total = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        ta = a.encode(" " + text, add_special_tokens=False).ids if text else []
        tb = b.encode(text) if text else []
        if not text or b"".join(map(raw_a, ta)) != whole or b"".join(map(raw_b, tb)) != whole:
            out.append((doc, [], [], [], []))
            continue
        spans = []
        for ids, raw in ((ta, raw_a), (tb, raw_b)):
            end, s = 0, []
            for i in ids:
                s.append((end, end + len(raw(i)), i))
                end = s[-1][1]
            spans.append(s)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        total.update(links)
        groups, i, j = [], 0, 0
        for end in sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}):
            ga, gb = [], []
            while i < len(spans[0]) and spans[0][i][1] <= end:
                ga.append(str(spans[0][i][2]))
                i += 1
            while j < len(spans[1]) and spans[1][j][1] <= end:
                gb.append(str(spans[1][j][2]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        out.append((doc, ta, tb, links, groups))
    most = {}
    for (x, y), n in total.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(((d, len(ta), len(tb), len(g), len(ls), sum(total[p] == most[p[1]] for p in ls), sum(total[p] for p in ls),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if ta else "") for d, ta, tb, ls, g in out), key=str)


@pytest.mark.parametrize("part", [1, 300, 8 << 20])
def test_matches_brute_force(spark, docs_of, rng, monkeypatch, part):
    monkeypatch.setattr(alignment, "PART_BYTES", part)
    rows = [(0, None), (1, "")] + list(enumerate(ODD, 2))
    rows += [(i, words(rng, rng.randint(1, 40)) + rng.choice(["", " ", "\n"]) + rng.choice(ODD)) for i in range(50, 90)]
    rows += [rows[5], rows[40], (None, "river stone"), (None, "river"), (7, "other text")]
    got = alignment.align(docs_of(rows), *PATHS).collect()
    want = brute(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(w[1] == 0 for w in want) and any(0 < w[5] < w[4] for w in want)


def test_empty(spark, docs_of):
    assert alignment.align(docs_of([]), *PATHS).count() == 0
    assert [tuple(r) for r in alignment.align(docs_of([(4, None)]), *PATHS).collect()] == [(4, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_cut_only_where_both_sides_end():
    pair = alignment.tokenizers(*PATHS)
    for text in ODD:
        assert " ".join(pair.pieces(text)) == text
        whole = pair.a.encode_ordinary(" " + text)
        assert [i for p in pair.pieces(text) for i in pair.a.encode_ordinary(" " + p)] == whole
        assert [i for p in pair.pieces(text) for i in pair.b.encode(p)] == pair.b.encode(text)
