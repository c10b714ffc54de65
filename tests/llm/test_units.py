"""The operators' local parts against the tokenizer libraries and brute force."""

import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import xxhash

from skygrid.llm import bpe, chat, decontam, lm, mixing, recurrent, simhash, template, token_counts, toxicity


def _texts(n, seed):
    rnd = random.Random(seed)
    kinds = [lambda: rnd.randint(32, 126), lambda: rnd.randint(160, 0x2FF), lambda: rnd.randint(0x400, 0xD7FF),
             lambda: rnd.randint(0x1F300, 0x1F700), lambda: 32, lambda: 10, lambda: 97, lambda: 101, lambda: 39]
    out = ["".join(chr(rnd.choice(kinds)()) for _ in range(rnd.randint(0, 120))) for _ in range(n)]
    return out + ["", "a" * 3000, " " * 200, "it's we're they'll I've   \t ok  ", "the" * 700, "<|endoftext|> x"]


def test_bpe_equals_the_library():
    import tiktoken
    e = bpe.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.vocab.ranks, special_tokens={})
    texts = _texts(200, 1)
    ids = e.encode(texts)
    assert ids == [lib.encode_ordinary(t) for t in texts]
    assert e.encode(texts[:50]) == ids[:50]          # with pieces known by now
    import pyarrow as pa
    for t, x in zip(texts, ids):
        assert b"".join(e.decode(pa.array(x, pa.int64())).to_pylist()) == t.encode()
    assert e.decode(pa.array([0, -1, e.vocab.size, None])).null_count == 3


def test_merge_replay_returns_to_lower_ranks():
    # "bc" is merged late, but "abc" early: the replay must go back to a lower rank.
    class Tiny(bpe.Vocabulary):
        def __init__(self):
            self.ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bcd": 256, b"cd": 301, b"abcd": 257}
            self.size, self.tokens = 302, [None] * 302
            for t, i in self.ranks.items():
                self.tokens[i] = t
            self.bytes = list(range(256))
            self.merges = {}
            for t, i in self.ranks.items():
                for cut in range(1, len(t)):
                    if t[:cut] in self.ranks and t[cut:] in self.ranks:
                        self.merges[self.ranks[t[:cut]] << 20 | self.ranks[t[cut:]]] = i

    def one_by_one(vocab, data):
        ids = [vocab.ranks[data[i:i + 1]] for i in range(len(data))]
        while True:
            found = min(((vocab.merges[a << 20 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:]))
                         if a << 20 | b in vocab.merges), default=None)
            if found is None:
                return tuple(ids)
            ids[found[1]:found[1] + 2] = [found[0]]
    rnd, vocab = random.Random(2), Tiny()
    words = [bytes(rnd.choice(b"abcd") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    assert bpe.replay(vocab, words) == [one_by_one(vocab, w) for w in words]


def test_token_counts_at_every_prefix():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, c = Tokenizer.from_file(path), token_counts.Counter(path)

    def count(t):
        return len(lib.encode(t, add_special_tokens=False).ids)
    texts = _texts(60, 3) + ["x  <|endoftext|>  <|endoftext|> y", "a\u0558b \U0003d005c"]
    assert [c.total(t) for t in texts] == [count(t) for t in texts]
    for t in [t for t in texts if len(t) < 130]:
        table, want = c.prefixes(t), [count(t[:i]) for i in range(len(t) + 1)]
        assert [table.count(i) for i in range(len(t) + 1)] == want
        for limit in (0, 3, 10):
            fit = max(i for i, n in enumerate(want) if n <= limit)
            assert table.fit(limit) == fit and c.measure(t, limit) == (want[-1], fit)


def test_template_language():
    def render(source, filters=None, **values):
        return list(template.compile_template(source, values, filters)(**values))

    def text(source, **values):
        return "".join(t for t, _ in render(source, **values))
    messages = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}, {"role": "user"}]
    assert text("{% for m in messages %}{{ loop.index }}{{ m.role }}{% if not loop.last %}, {% endif %}{% endfor %}",
                messages=iter(messages)) == "1user, 2assistant, 3user"
    assert text("{% if m['text'] == 'a' and 'x' in 'xy' %}1{% elif true %}2{% else %}3{% endif %}", m=messages[0]) == "1"
    assert text("{% set x = 'a' ~ (1 + 2) %}{{ x | upper }}{{ none }}{{ true }}", m=1) == "A3true"
    assert text("{{ 'it\\'s' ~ \"\\n\" }}", m=1) == "it's\n"
    assert render("a{% generation %}b{{ m }}{% endgeneration %}c", m=1) == [
        ("a", False), ("b", True), ("1", True), ("c", False)]
    # Constants, branches never taken and neighbouring texts fold to one text.
    tree = template.fold(template.parse("a{{ 'b' | upper }}{% if 1 == 2 %}{{ m }}{% else %}c{% endif %}d",
                                        template.FILTERS), template.FILTERS)
    assert tree == [("text", "aBcd")]


@pytest.mark.parametrize("bad", [
    "{{ x }}", "{{ m | nope }}", "{{ m.role( ) }}", "{{ m.__class__.__mro__ }}x{{ y }}", "{% for m in messages %}",
    "{% endif %}", "{% include 'x' %}", "{{ 'a }}", "{{ }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}"])
def test_template_errors(bad):
    with pytest.raises(template.TemplateError):
        template.compile_template(bad, ["messages", "m"])


def test_template_sandbox():
    render = template.compile_template("{{ m.__class__ }}", ["m"])
    assert "".join(t for t, _ in render(m={})) == ""            # a key, never a Python attribute
    with pytest.raises(template.TemplateError):
        list(render(m="text"))


def test_escaping_is_reversible():
    rnd = random.Random(4)
    parts = ["\\", "###", "</turn>", "#", "<", "/turn>", "a", "\n", ":", "é"]
    for _ in range(500):
        turns = [("".join(rnd.choices(parts, k=rnd.randint(0, 6))), "".join(rnd.choices(parts, k=rnd.randint(0, 9))))
                 for _ in range(rnd.randint(1, 4))]
        render = template.compile_template(chat.TEMPLATE, filters=chat.FILTERS)
        out = "".join(t for t, _ in render(messages=[{"role": r, "text": t} for r, t in turns]))
        assert list(chat.read_turns(out)) == turns


def test_fingerprints_equal_the_definition():
    rnd = random.Random(5)
    for n in (0, 1, 2, 3, 4, 50, 3000):
        text = " ".join(rnd.choice("Ab cÄ d\t e".split(" ")) + str(rnd.randint(0, 9)) for _ in range(n))
        words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(None) == 0


@pytest.mark.parametrize("shard_rows,sample", [(8192, 4000), (40, 600)])
def test_vantage_point_routing_loses_no_pair(shard_rows, sample):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
    flips = lambda x, k: x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64))
    near = [flips(rng.choice(base), int(k)) for k in rng.integers(1, 5, 800)]
    ball = [flips(base[0], int(k)) for k in rng.integers(1, 4, 600)]        # a dense group
    points = np.unique(np.concatenate((base, np.array(near + ball, np.uint64), [np.uint64(0)])))
    i, j = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3, 1))
    met = set()
    for half in simhash.HALVES:
        tree, n_shards = simhash.build_tree(points[::max(1, len(points) // sample)], half,
                                            max(1, len(points) // sample), 3, shard_rows)
        homes = 0
        for _, own, visiting in simhash.route(tree, points, points[:0]):
            homes += len(own)
            o, all_ = set(own.tolist()), set(own.tolist()) | set(visiting.tolist())
            met |= {(a, b) for a, b in zip(points[i].tolist(), points[j].tolist())
                    if (a in o and b in all_) or (b in o and a in all_)}
        assert homes == len(points)
    assert len(met) == len(i) > 1000


def test_local_links_join_the_right_components():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    points = np.unique(np.concatenate((base, base[:200] ^ np.uint64(5), base[:100] ^ np.uint64(1 << 40))))
    forest = simhash.Forest(len(points))
    everything = np.arange(len(points))
    for half in simhash.HALVES:
        simhash._link(points, forest, everything, everything[:0], half, 3, 16)
    want = list(range(len(points)))

    def root(x):
        while want[x] != x:
            x = want[x]
        return x
    for a, b in zip(*np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3, 1))):
        want[max(root(a), root(b))] = min(root(a), root(b))
    roots = forest.roots(everything)
    pairs = {(int(r), root(k)) for k, r in enumerate(roots)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_word_points_and_hashes():
    texts = ["Ärger im Haus, 3x!", "", "ärger IM  haus 3X", "\U0001d54f½"]
    h, owner = decontam.Hasher().words(texts)
    assert h[owner == 0].tolist() == h[owner == 2].tolist() and len(h[owner == 0]) == 4
    assert len(h[owner == 1]) == 0
    table = decontam._word_points()
    for c in "aÄ9½\u4e00\U0001d54f_-\n ":
        assert table[ord(c)] == (unicodedata.category(c)[0] in "LN")


def test_containment_search_equals_brute_force():
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=n))) for k, n in enumerate([1, 3, 5, 6, 9, 14, 30, 80, 200])]
    docs = []
    for _ in range(150):
        words = rnd.choices(vocabulary, k=rnd.randint(0, 120))
        item = rnd.choice(items)[1].split()
        for k in range(len(item)):
            if rnd.random() < 0.03:
                item[k] = "other"
        at = rnd.randint(0, len(words))
        docs.append(", ".join(words[:at] + [w.upper() for w in item] + words[at:]))
    index = decontam.Index(items, 5, 0.8)
    got = {(t, item[0], n) for t, item, n in index.search(docs, decontam.Hasher())}
    want = set()
    for t, d in enumerate(docs):
        w = decontam.WORD.findall(d.lower())
        for k, text in items:
            size, shingles = decontam.item_shingles(text)
            n = len(shingles & {" ".join(w[i:i + size]) for i in range(len(w) - size + 1)})
            if 5 * n >= 4 * len(shingles):
                want.add((t, k, n))
    assert got == want and len({k for _, k, _ in want}) >= 6


def test_byte_model_is_a_distribution_and_learns():
    texts = [b"the cat sat on the mat. " * 3, b"the dog sat on the log. " * 3, b"", b"x" * 50]
    packed = np.concatenate([p for p, _ in mixing.windows(texts)])
    assert len(packed) == sum(len(t) + 1 for t in texts)
    long = [np.concatenate([p for p, _ in mixing.windows([t], chunk=7)]) for t in texts]
    assert np.array_equal(np.concatenate(long), packed)       # cut texts give the same windows
    values, index = mixing.distinct(packed)
    assert np.array_equal(values[index], packed) and len(values) == len(np.unique(packed))
    counts = mixing.empty_counts()
    mixing.add_counts(counts, values, np.bincount(index))
    model = mixing.Model(counts)
    model.learn([p for p, _ in mixing.windows(texts[:2])], counts, per_text=40)
    after = (packed[30] & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
    assert abs((2.0 ** -model.bits(after)).sum() - 1) < 1e-5      # probabilities of all next bytes
    seen, unseen = (model.bits(np.concatenate([p for p, _ in mixing.windows([t])])).mean()
                    for t in (b"the cat sat on the mat.", b"qzj vkx wpy bfg"))
    assert seen < 2 < unseen


def test_counts_of_contexts_are_exact():
    rng = np.random.default_rng(12)
    packed = np.unique(rng.integers(0, 1 << 56, 200_000).astype(np.uint64))      # far more contexts than fixed tables held
    counts = mixing.empty_counts()
    mixing.add_counts(counts, packed, np.full(len(packed), 1 << 24))
    mixing.add_counts(counts, packed[:1], np.array([1]))
    known = counts.bits(6, packed[:3])
    assert known.max(axis=0).tolist() == [[(1 << 24) + 1, 1 << 24, 1 << 24]] * 8 and not known.min(axis=0).any()
    unknown = np.setdiff1d(rng.integers(0, 1 << 56, 50_000).astype(np.uint64) | np.uint64(255), packed | np.uint64(255))
    assert not counts.bits(6, unknown).any()                  # no context is taken for another
    symbols = (packed & np.uint64(255))[(packed >> np.uint64(8)) & np.uint64(255) == 7].astype(int)
    zeros, ones = counts.bits(1, np.array([7 << 8 | 200], np.uint64))[:, 0, 0] >> 24
    assert (zeros, ones) == ((symbols < 128).sum(), (symbols >= 128).sum())


def test_merged_windows():
    rng = np.random.default_rng(10)
    held = [(np.unique(rng.integers(0, 300, 200)).astype(np.uint64) << np.uint64(40),) for _ in range(3)]
    held = [(v, rng.choice([1, 2, 255, 256, 70000], len(v)).astype(np.int64)) for v, in held]
    values, n = lm._merged(held)
    want = {}
    for v, c in held:
        for a, b in zip(v.tolist(), c.tolist()):
            want[a] = want.get(a, 0) + b
    assert dict(zip(values.tolist(), n.tolist())) == want and (np.diff(values.astype(np.int64)) > 0).all()
    back, m = lm._unpacked(lm._packed(values, n), len(n))
    assert np.array_equal(back, values) and np.array_equal(m, n)


@pytest.mark.parametrize("slice_bytes, readings", [(1 << 20, 1), (50, 2)])
def test_scoring_reads_the_windows_of_a_slice_once(monkeypatch, slice_bytes, readings):
    calls = []

    def counted(*args):
        calls.append(1)
        return read(*args)
    read = mixing.windows
    monkeypatch.setattr(mixing, "windows", counted)
    monkeypatch.setattr(lm, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lm, "CHUNK", 64)
    texts = [t.encode() for t in _texts(30, 9)] + [b"", b"ab" * 90]
    got = lm._window_costs(texts, lambda values: (values % np.uint64(1009)).astype(np.float32))
    assert len(calls) == readings
    want = [sum(int(w) % 1009 for p, _ in read([t]) for w in p) for t in texts]
    assert got.tolist() == want
    assert lm._window_costs([], lambda values: values.astype(np.float32)).tolist() == []


def test_recurrent_gradients():
    rng = np.random.default_rng(9)
    p = {k: v.astype(np.float64) for k, v in recurrent.init_layer(rng, 3, 2, 2).items()}
    x, mask = rng.standard_normal((4, 5, 3)), (np.arange(4)[:, None] < [4, 2, 1, 0, 3]).astype(float)
    target = rng.standard_normal((5, 4))

    def loss():
        f, b = recurrent.project(p, x)
        return (recurrent.pool(p, lambda t: f[t], lambda t: b[t], mask)[0] * target).sum()
    f, b = recurrent.project(p, x)
    _, cache = recurrent.pool(p, lambda t: f[t], lambda t: b[t], mask, keep=True)
    grads, df, db = recurrent.pool_back(p, cache, target)
    for way, parts in (("f", df), ("b", db)):
        grads["W" + way] = np.einsum("tri,trj->ij", x, np.stack(parts))
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in g.shape)
        p[name][at] += 1e-4
        up = loss()
        p[name][at] -= 2e-4
        assert abs((up - loss()) / 2e-4 - g[at]) < 2e-3, name
        p[name][at] += 1e-4


def test_windows_cover_all_words_and_cut_long_ones():
    words = toxicity._Words(["", "one two", " ".join(f"w{k}" for k in range(40)), "x" * 60], decontam.Hasher())
    windows, owner = words.windows()
    assert np.bincount(owner).tolist() == [1, 1, 4, 1]
    covered = {int(w) for w in windows[owner == 2].ravel() if w >= 0}
    assert len(covered) == 40 and (windows[0] == -1).all()
    assert sorted(words.length[windows[owner == 3][0][:3]].tolist()) == [12, 24, 24]


def test_words_merged_together_equal_lists_of_positions():
    vocab = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(5)
    bits = [b"a", b"the", b"ing", b" ", b"\xc3\xa9", b"\xff", b"aaaa", b"\n", b"1", b"ll"]
    words = [b"".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20))) for _ in range(3000)]
    words += [b"", b"", b" " * 32, b" " * 33, b"a" * 5000]
    assert bpe.replay(vocab, words) == bpe.replay_listed(vocab, words)
    assert bpe.replay(vocab, []) == []


def test_known_pieces_and_tables_stay_small():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    e = bpe.Encoder(path, public_tokenizers.PATTERN)
    texts = _texts(400, 8)
    ids = e.encode(texts)
    n = sum(map(len, bpe.replay(e.vocab, [piece.encode() for piece in e.known])))
    assert sum(map(sys.getsizeof, e.known.values())) <= 36 * len(e.known) + 4 * n
    assert [np.frombuffer(x, np.int32).tolist() for x in e.encode_packed(texts)] == ids
    # A worker that decodes makes no tables of merges.
    import pyarrow as pa
    d = bpe.Encoder(path, public_tokenizers.PATTERN)
    d.decode(pa.array([1, 2, 3], pa.int64()))
    assert not {"merges", "pair_ranks", "words", "byte_pairs"} & set(vars(d.vocab))


def test_rows_are_cut_by_their_sizes():
    import pyarrow as pa
    from skygrid.llm.common import row_slices
    batch = pa.record_batch([pa.array(range(7))], ["i"])
    parts = [p.column(0).to_pylist() for p in row_slices(batch, [1, 2, 9, 0, 3, 1, 1], 3)]
    assert parts == [[0, 1], [2], [3, 4], [5, 6]]
    assert list(row_slices(batch.slice(0, 0), [], 3)) == []


def test_prefix_tables_made_together_equal_single_ones():
    c = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(6)
    bits = ["a", "the", "ing", " ", "é", "日本", "😀", "aaaa", "\n", "1", "'s", "Ж"]
    pieces = list({"".join(rnd.choice(bits) for _ in range(rnd.randint(1, 12))) for _ in range(3000)})
    for piece, table in zip(pieces, c.tokenizer.columns.tables(pieces)):
        counts = c.tokenizer.prefix_counts(piece.encode())
        ends = [len(piece[:i].encode()) for i in range(len(piece) + 1)]
        assert (table is None) == (len(piece.encode()) > token_counts.LONGEST)
        assert table is None or list(table) == [counts[e] for e in ends]
    assert c.tokenizer.columns.tables([]) == []


def test_tokens_apart_by_undoing_merges_equal_encoding():
    t = token_counts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    rnd, ids = random.Random(7), sorted(t.token)
    a, b = (rnd.choices(ids, k=4000) for _ in range(2))
    apart = t.columns.fits(np.array(a), np.array(b))
    assert [t.fits(x, y) for x, y in zip(a, b)] == apart.tolist() and not apart.all()


def test_texts_measured_together_or_alone():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["", "a" * 400 + " b", "<|endoftext|>x<|endoftext|>", " \n\n  é" * 50, *_texts(60, 8)] * 2
    alone, together = token_counts.Counter(path), token_counts.Counter(path)
    assert together.measure_all(texts, 20) == [alone.measure(t, 20) for t in texts]


def test_words_of_equal_letter_sums_are_counted_apart():
    word = b"a"
    for _ in range(10):     # the Thue-Morse word of 1,024 letters, and its complement
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    texts = [word + b" " + other, b"", b"  Ab\tba AB ", other]
    h, owner = lm._Words().hashes(texts)
    assert owner.tolist() == [0, 0, 2, 2, 2, 3]
    assert h[0] != h[1] and h[1] == h[5] and h[2] == h[4] != h[3]
    assert [len(x) for x in lm._Words().hashes([b""])] == [0, 0]
    rnd = random.Random(9)
    words = list({bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 9))) for _ in range(20000)})
    assert len(np.unique(lm._Words().hashes([b" ".join(words)])[0])) == len(words)


def test_long_texts_take_no_short_ones_place():
    mib = 1 << 20
    # 1,000 short positives beside texts of 12 GiB in all; negatives within the bound.
    got = toxicity.shares([(1, 10, 1000, 10 ** 6), (1, 30, 12, 12 << 30), (0, 10, 4000, 4 * 10 ** 6)], 1200, 12 * mib)
    assert got[1, 10] == 1.0 and got[1, 30] * (12 << 30) <= 12 * mib
    assert got[0, 10] == 0.3
    assert toxicity.shares([(1, 0, 5, 0)], 1200, 12 * mib) == {(1, 0): 1.0}
    assert toxicity.shares([], 1200, 12 * mib) == {}
    many = toxicity.shares([(0, k, 10 ** 6, 10 ** 6 << k) for k in range(30)], 1200, 12 * mib)
    assert sum(p * (10 ** 6 << k) for (_, k), p in many.items()) <= 12 * mib * 1.001
    assert max(many.values()) <= 1200 / (30 * 10 ** 6) * 1.001
