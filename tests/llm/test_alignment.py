import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_rows import docs, prose
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shopflow.llm import alignment

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))

TEXTS = [
    "Hello world, tokenizers!", "", None, "a", " lead", "two  blanks", "tab\tand\nline", "naïve café №5", "ﬁne é",
    "日本語のテキスト 漢字", "😀😀 smile", "<|endoftext|> <s> </s> <unk> ▁x <0x41>", "word " * 30, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "Hello world, tokenizers!", "1234567 890", "\x00\x7f", "x" * 3000 + " y", "مرحبا بالعالم", "nbsp here",
]


def brute(texts):
    """Sets of byte positions per token, all pairs of tokens."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    rows = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(k)) for k in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()
                   for k, p in ((k, b.id_to_piece(k)) for k in ids_b)]
        data = (" " + (text or "")).encode()
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []

        def spans(parts):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            return list(zip([0, *ends], ends))

        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        links = [(i, j) for i, x in enumerate(spans_a) for j, y in enumerate(spans_b) if set(range(*x)) & set(range(*y))]
        cuts = sorted({y for _, y in spans_a} & {y for _, y in spans_b})
        groups, low = [], 0
        for high in cuts:
            groups.append(([i for i, x in enumerate(spans_a) if low <= x[0] < high],
                           [j for j, y in enumerate(spans_b) if low <= y[0] < high]))
            low = high
        rows.append((ids_a, ids_b, links, groups))
    held = Counter(p for a_, b_, links, _ in rows for p in {(a_[i], b_[j]) for i, j in links})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for ids_a, ids_b, links, groups in rows:
        shown = ";".join(",".join(str(ids_a[i]) for i in x) + "|" + ",".join(str(ids_b[j]) for j in y) for x, y in groups)
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        out.append((len(ids_a), len(ids_b), len(groups), len(links), sum(held[p] == top[p[0]] for p in pairs),
                    sum(held[p] for p in pairs), hashlib.sha256(shown.encode()).hexdigest() if shown else "",
                    sum(len(x) * len(y) for x, y in groups)))
    return out


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 8])
def test_summary_equals_all_pairs_of_byte_sets(spark, monkeypatch, frequent):
    """With 8, most pairs go by the join; with the default, all are broadcast."""
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    texts = [*TEXTS, prose(1, 300), prose(1, 300), prose(2, 200)]
    got = alignment.summary(docs(spark, [(k, t) for k, t in enumerate(texts)]), A, B).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts)


def test_pieces_are_encoded_as_within_their_text():
    pair = alignment.Pair(alignment.read_model(A), alignment.read_model(B))
    texts = [t for t in TEXTS if t] + ["a\nb c", "a \nb", "x▁ y", "x ▁y", "don't won't 's 's", "1 2 3 a1 b2", "a,b , c",
                                       "tail ", " x", "\u3000 a b", "é è\u0301 ü", "a \u0301b", prose(9, 200)]
    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    for text in texts:
        pieces = alignment.pieces_of(text)
        assert " ".join(pieces) == text
        a, first, b, _ = pair.encode(pieces)
        if not all(first[1:] > first[:-1]):  # a piece that its tokens do not spell: so it is for the text
            assert [len(x) for x in pair.encode([text])] == [0, 2, 0, 2]
            continue
        assert a.tolist() == whole.encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == SentencePieceProcessor(model_file=B).encode(text)


def test_pieces_put_together_are_encoded_as_alone(monkeypatch):
    pair = alignment.Pair(alignment.read_model(A), alignment.read_model(B))
    plain = [p for t in TEXTS if t for p in alignment.pieces_of(t) if p == p.strip() and "▁" not in p and "<" not in p]
    for joined in (4096, 10, 1):
        monkeypatch.setattr(alignment, "JOINED", joined)
        for x, y in zip(pair.encode_plain(plain), pair.encode(plain)):
            assert x.tolist() == y.tolist()
    odd = [*plain, "a▁b"]  # not spelt: falls back
    assert [x.tolist() for x in pair.encode_plain(odd)] == [x.tolist() for x in pair.encode(odd)]


def test_product_is_a_matrix_product(monkeypatch):
    rng = np.random.default_rng(3)
    for entries in (1 << 20, 7):
        monkeypatch.setattr(alignment, "ENTRIES", entries)
        x, y = (rng.random(shape) < 0.3 for shape in ((9, 12), (12, 8)))

        def csr(m):
            return alignment.Csr(np.concatenate(([0], np.cumsum(m.sum(1)))), np.nonzero(m)[1])

        full = np.zeros((9, 8), int)
        for row, column, value in alignment.product(csr(x), csr(y)):
            full[row, column] += value
        assert (full == x.astype(int) @ y.astype(int)).all()
        back = alignment.transpose(csr(x), 12)
        assert (back.first == csr(x.T).first).all() and (back.index == csr(x.T).index).all()


def test_alignments_rebuild_the_text(spark):
    rows = {r.doc_id: r for r in alignment.alignments(docs(spark, list(enumerate(TEXTS))), A, B).collect()}
    ends = rows[0]
    assert ends.a_ends[-1] == ends.b_ends[-1] == len(TEXTS[0]) + 1
    starts_a, starts_b = [0, *ends.a_ends], [0, *ends.b_ends]
    overlap = {(i, j) for i in range(len(ends.a_ids)) for j in range(len(ends.b_ids))
               if max(starts_a[i], starts_b[j]) < min(ends.a_ends[i], ends.b_ends[j])}
    assert {(x.a, x.b) for x in ends.links} == overlap and len(ends.links) == len(overlap)
    assert {(i, j) for i, j in overlap if ends.a_groups[i] != ends.b_groups[j]} == set()
    assert rows[1].a_ids == [] and rows[2].links == []


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment.Units, "KEPT", 20)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 50)  # long texts are cut at blanks between letters
    long = prose(4, 400) + "  two blanks " + prose(5, 50)
    rows = [(None, "same text"), (7, "same text"), (7, "same text"), (8, None), (9, long), (10, "q" * 500)]
    got = alignment.summary(docs(spark, rows), A, B).collect()
    assert len(got) == 6 and sorted((r.doc_id or 0) for r in got) == [0, 7, 7, 8, 9, 10]
    same = {tuple(r)[1:] for r in got if r.doc_id in (None, 7)}
    assert len(same) == 1
    want = brute([t for _, t in rows])
    assert {tuple(r)[1:] for r in got} == set(want)
    assert alignment.summary(docs(spark, []), A, B).count() == 0
