"""Filter audit, token alignment and URL filters against plain versions and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import filter_audit, token_align, url_filter
from clickloom.llm.tokens import vocabulary

DOCS = "doc_id bigint, text string, lang string, part string, mask bigint, n int"
LABELS = "doc_id bigint, quality int, toxic int"
LONG = " ".join(f"word{i % 97}x{i % 89}" for i in range(30_000))
TEXTS = [None, "", " \t\n", "one", "one", "A B C", "50% of 3 | 4", "é ü 你好 😀 don't <|endoftext|> x  y\n\n z",
         "x" * 9000, " " * 9000, LONG, LONG, "tab\tand\x0bvertical\x0cform\u00a0hard\u2003wide", "a\u0300 e\u0301 \ufb01",
         "▁under <0x41> <s> </s> <unk>", "\x00 zero", "ÀÉ Straße naïve 1234567 Don'T I'LL", "\r\n\r\n  end  "]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def fails(docs):
    """doc position -> letters it fails."""
    first, found = {}, []
    for i, text, *_ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, *_ in docs:
        text = text or ""
        own = words(text)
        found.append("".join(x for x, f in (
            ("A", len(own) < 100), ("B", 100 * len(set(own)) < 80 * len(own)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
            ("D", re.search("[#$%&*|]", text)), ("E", i is not None and first[text] < i)) if f))
    return found


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    letters, out = fails(docs), {}
    for part in {d[2] or "" for d in docs}:
        own = [(d[0], f) for d, f in zip(docs, letters) if (d[2] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone),
                    sum(f == letter for _, f in own), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone), letter]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shapley[row[6]]
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    found = filter_audit.audit(docs, labels).collect()
    rows = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}
    assert len(rows) == len(found)
    return rows


def test_audit_equals_every_order_run_one_by_one(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(f"{rng.choice('aB#')}{rng.randint(0, 400)}" for _ in range(rng.randint(80, 130)))
                     for _ in range(30)]
    texts += [rng.choice(texts) for _ in range(40)]
    docs = [(i, t, rng.choice(["en", "de", "", None]), "clash", 7, 1) for i, t in enumerate(texts)]
    docs += [(None, "one", "en", "clash", 7, 1), (3, "one", "fr", "clash", 7, 1), (3, "one", "fr", "clash", 7, 1)]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60)] + [(None, 1, 1), (3, 1, 1)]
    assert audited(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)) \
        == brute_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    none, no_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, no_labels).count() == 0
    one = [(1, None, None, "", 0, 0)]
    assert audited(spark.createDataFrame(one, DOCS), no_labels) == brute_audit(one, [])


def test_audit_takes_other_filters_and_refuses_repeated_letters(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a", "x")], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    two = (filter_audit.Filter("S", "n_words < 2"), filter_audit.Filter("T", "n_chars < 9"))
    found = {(r.filter_order, r.step): (r.removed, r.redundant, r.shapley)
             for r in filter_audit.audit(docs, labels, two).collect()}
    assert found == {("ST", 1): (1, 0, 1), ("ST", 2): (1, 1, 3), ("TS", 1): (2, 0, 3), ("TS", 2): (0, 1, 1)}
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, (two[0], two[0]))


@pytest.fixture(scope="module")
def own():
    return token_align.tokenizers(*(vocabulary(v) for v in (
        token_align.VOCABULARY_A, token_align.RANKS_A, token_align.VOCABULARY_B)))


def brute_align(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary(token_align.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(token_align.VOCABULARY_B))
    from clickloom.llm.bpe import byte_alphabet
    alphabet = byte_alphabet()
    tokens = []
    for text in texts:
        one = a.encode(" " + text, add_special_tokens=False).ids if text else []
        two = b.encode(text) if text else []
        bytes_one = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in one]
        bytes_two = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                     else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
        raw = (" " + text).encode() if text else b""
        whole = b"".join(bytes_one) == raw == b"".join(bytes_two)
        tokens.append([list(zip(one, map(len, bytes_one))), list(zip(two, map(len, bytes_two)))] if whole else [[], []])
    linked = []
    for one, two in tokens:
        place = [[], []]
        for side, listed in enumerate((one, two)):
            for number, (_, n) in enumerate(listed):
                place[side] += [number] * n
        linked.append([(one[i][0], two[j][0]) for i, j in dict.fromkeys(zip(*place))])
    count = Counter(pair for links in linked for pair in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (one, two), links in zip(tokens, linked):
        ends = [list(itertools.accumulate(n for _, n in side)) for side in (one, two)]
        both = sorted(set(ends[0]) & set(ends[1]))
        told, at = [], 0
        for end in both:
            told.append("|".join(",".join(str(i) for (i, _), e in zip(side, e_) if at < e <= end)
                                 for side, e_ in zip((one, two), ends)))
            at = end
        out.append((len(one), len(two), len(both), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(";".join(told).encode()).hexdigest() if one else ""))
    return out


SHORT = [t if t is None or len(t) < 20_000 else t[:3000] for t in TEXTS]


@pytest.mark.parametrize("known", [token_align.KNOWN, 5, 0])
def test_alignment_equals_byte_by_byte_comparison(spark, known):
    texts = SHORT + [f"The {w} of the {v}." for w in ("cat", "House", "naïveté") for v in ("sea", "Straßenbahn")]
    docs = [(i, t, "en", "clash", 1, 2) for i, t in enumerate(texts)] + [(None, "one", "en", "", 1, 2)] * 2
    found = token_align.align(spark.createDataFrame(docs, DOCS).repartition(3), known=known).collect()
    expected = Counter((d[0], *row) for d, row in zip(docs, brute_align([d[1] or "" for d in docs])))
    assert Counter(map(tuple, found)) == expected


def test_alignment_of_an_empty_table(spark):
    assert token_align.align(spark.createDataFrame([], DOCS)).count() == 0


def test_both_encoders_of_a_agree(own):
    rng = random.Random(8)
    marks = ["a", "B", "é", "ß", "'s", "'LL", " ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c", "12", "½", "²", ".", "_", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(1, 40)))
        assert own._fast(" " + text) == own._a.encode(" " + text, add_special_tokens=False).ids, text


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2, (9, 14)), rng.integers(0, 2, (14, 7))

    def rows(dense):
        return token_align.Rows(np.concatenate([[0], np.cumsum(dense.sum(axis=1))]),
                                np.nonzero(dense)[1], dense.shape[1])
    i, j, value = token_align.product(rows(a), rows(b))
    dense = np.zeros((9, 7), int)
    dense[i, j] = value
    assert (dense == a @ b).all()
    assert (token_align.group_rows(np.array([0, 0, 1])).transposed().columns == [0, 0, 1]).all()
    group_a, group_b = token_align.groups(np.array([2, 2, 3]), np.array([1, 3, 3]))
    assert list(token_align.shared_group_links(group_a, group_b)) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2)]


PAGES = "page_id bigint, url string, host string, template string, verdict string"
URLS = {None: ("", "", None), "": ("", "", None), "no scheme": ("", "", None), "http://": ("", "", None),
        "http://EXAMPLE.com/en/x?q#f": ("example.com", "/en/x", "example.com/en/"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/"),
        "https://WWW.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "https://x.www.example.com/en/1": ("x.www.example.com", "/en/1", "www.example.com/en/"),
        "https://www.example.com/EN/": ("www.example.com", "/EN/", "com/"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "https://a.com": ("a.com", "", None), "https://a.com?x=/": ("a.com", "", None),
        "https://com/": ("com", "/", "com/"), "https://a.net/es/a": ("a.net", "/es/a", "net/es/"),
        "https://a.net#/fr/": ("a.net", "", None), "https://a.net/fr/b": ("a.net", "/fr/b", "net/fr/"),
        "x://y://a.com/": ("y:", "//a.com/", None), "https://a.com:80/": ("a.com:80", "/", None),
        "https://É.com/": ("É.com", "/", "com/"), "https://a.org/" + "s/" * 3000: ("a.org", "/" + "s/" * 3000, None)}


def test_rules_of_urls(spark):
    pages = [(i, u, "clash", "clash", "clash") for i, u in enumerate(URLS)] + [(None, "https://a.com/", "", "", "")] * 2
    found = url_filter.judge(spark.createDataFrame(pages, PAGES)).collect()
    assert len(found) == len(pages)
    by_id = {r.page_id: r for r in found}
    verdicts = {"com/": "allow", "www.example.com/en/": "allow", None: None}
    for i, (url, (host, path, rule)) in enumerate(URLS.items()):
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (verdicts.get(rule, "block") or r.verdict) and r.verdict in ("allow", "block"), url
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_templates_generalise_what_varies_and_impure_ones_are_rejected(spark):
    rules = (("block", "shop.org", "/ads/1"), ("allow", "shop.org", "/news/1"))
    urls = [f"http://shop.org/{kind}/{n}/{what}" for kind in ("ads", "news") for n in range(100, 200)
            for what in ("view", "edit")]
    urls += [f"http://shop.org/ads/{n}/{what}" for n in range(900, 910) for what in ("view", "edit")]
    urls += [f"http://shop.org/news/{n}/view" for n in range(900, 910)] + ["http://other.org/about"]
    pages = [(i, u, "", "", "") for i, u in enumerate(urls)]
    found = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(pages, PAGES), rules).collect()}
    by_template = defaultdict(set)
    for i, url in enumerate(urls):
        r = found[i]
        by_template[r.template].add(r.verdict)
        kind = url.split("/")[3]
        assert r.verdict == ("block" if kind == "ads" else "allow"), url
    assert len(by_template) <= 6 and all(len(v) == 1 for v in by_template.values()), by_template


def test_shares_add_up_along_the_tree(spark):
    trees = spark.createDataFrame([("h", ["=a"], ["=a"], 10, 10, 10), ("h", ["=b"], ["=b"], 10, 10, 0)],
                                  "host string, template array<string>, merged array<string>, pages long, labelled long, blocked long")
    found = {r.template[0]: r.purity for r in url_filter.purities(trees).collect()}
    prior, smooth = 0.5, url_filter.SMOOTH
    root = (10 + smooth * prior) / (20 + smooth)
    expected = {}
    for name, blocked in (("=a", 10), ("=b", 0)):
        p = root
        for _ in range(2):
            p = (blocked + smooth * p) / (10 + smooth)
        expected[name] = p
    assert found == pytest.approx(expected)


def test_chunks_give_what_whole_texts_give_in_small_batches_of_narrow_ids(spark):
    own = token_align.tokenizers(*(vocabulary(v) for v in (
        token_align.VOCABULARY_A, token_align.RANKS_A, token_align.VOCABULARY_B)))
    rng = random.Random(5)
    marks = list(" \t\n\r\x1c\x85\xa0aZé½¨;)}'9,.<") + ["  ", " the", "'re", "\r\n", ";\r", "</s>", "▁", "中", " "]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    whole = [own._whole(*ids) if ids[0] else None for ids in map(own.encode, texts)]
    assert [x for i in range(0, 3000, 512) for x in own.aligned(texts[i:i + 512])] == whole
    assert sum(x is None for x in whole) > 20
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with token_align.arrow_rows(spark, 7):
        sizes = spark.range(40).coalesce(1).mapInArrow(
            lambda batches: (b.slice(0, 1) for b in batches), "id bigint").count()
    assert sizes == 6 and spark.conf.get(name) == before
    docs = spark.createDataFrame([(0, "plain words " * 9, "en", "web", 0, 0)], DOCS)
    row = token_align.encoded(docs).first()
    assert row.n_a > 0 and len(row.a) == 2 * row.n_a and len(row.b) == 2 * row.n_b
