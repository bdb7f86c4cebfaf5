import random

from cases import EDGES, SF, edges, empty
from tokenizers import Tokenizer

from fleetlens.llm import tokens
from fleetlens.llm.queries import QUERIES

TOK = Tokenizer.from_file(tokens.place(tokens.VOCABULARY))
SAMPLES = ["", " ", "  a", "a  ", "a \n\n b\t\tc", "don't we'll I'M", "<|endoftext|>", "x <|endoftext|>y", "1234 ½ ²x", " a\u0085b", "\x1ca\x1fb", "漢字 と 😀", " x 　 y", "A" * 5000, "é" * 300 + " é"]


def plain(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_query(spark):
    want = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_count_tokens"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        n = len(plain(want[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(want[r.doc_id].encode()), n, n > 1024)


def test_counts_and_ids_equal_the_library():
    rng = random.Random(4)
    letters = "ab Zé1½ \n\t'.,-_<|> \u0085ßÀ—漢😀s"
    texts = SAMPLES + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    counter = tokens.Counter(tokens.whole_tokens())
    assert counter.counts(texts) == [len(plain(t)) for t in texts]
    for text in texts:
        assert tokens.encode(text).tolist() == plain(text)


def test_splitter_classes_below_u0250():
    pre = TOK.pre_tokenizer
    for code in range(0x250):
        text = f"a{chr(code)}1 {chr(code)}{chr(code)}."
        spans = [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)]
        assert tokens.SPLIT.findall(text) == spans, hex(code)


def test_whole_tokens_are_proven():
    whole = tokens.whole_tokens()
    assert " the" in whole and "<|endoftext|>" not in whole and len(whole) > 40_000
    for text in random.Random(1).sample(sorted(whole), 500):
        assert len(plain(text)) == 1


def test_memo_limit(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 3)
    counter = tokens.Counter(tokens.whole_tokens())
    texts = [f"qzx{i}jk vvwq{i}" for i in range(50)]
    assert counter.counts(texts) == counter.counts(texts) == [len(plain(t)) for t in texts]


def test_edges(spark):
    rows = tokens.count_tokens(edges(spark)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == sorted((str(d), len((t or "").encode()), len(plain(t))) for d, t, *_ in EDGES)
    assert tokens.count_tokens(empty(spark)).count() == 0
