"""Every registered corpus query over whole tables against a brute-force version, or against its SQL."""

import hashlib
import os
import re
import string
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from auctionflow.llm import mixing, secrets, spotsigs, toxicity
from auctionflow.llm.oracle import ORACLE
from auctionflow.llm.queries import QUERIES, TOKENIZER

SF = os.environ.get("CORPUS_SF", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations", "benchmark"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, coalesce(text, ''), source FROM documents ORDER BY doc_id").fetchall()


def result(spark, name):
    full = next(q for q in QUERIES if q.startswith(name + "_"))
    return QUERIES[full](spark, SF).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(map(str, r)) for r in found.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == want


def test_op1_packs_all_ids(spark, docs):
    rows = result(spark, "op1")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _, _ in docs}
    total = 0
    for doc, text, _ in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        total += len(ids)
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert all(p.length == 1024 for p in pieces[1:]) and sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            own = ids[p.start:p.start + p.length]
            assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert len(by_sequence) <= 1.01 * total / 1024 + 1


def test_op2_held_out_accuracy(spark, duck, docs):
    rows = {r.doc_id: r for r in result(spark, "op2")}
    assert set(rows) == {d for d, _, _ in docs}
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = [(rows[d], y) for d, y in duck.execute("SELECT doc_id, toxic FROM labels").fetchall() if d in rows]
    held = [(r, y) for r, y in labels if r.held_out]
    wrong = sum(r.predicted != y for r, y in held)
    print("op2 held out", len(held), "wrong", wrong, Counter((r.predicted, y) for r, y in held))
    assert wrong <= (0.06 if len(held) >= 90 else 0.15) * len(held) + 1


def test_op3_finds_all_base_spans(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op3")}
    patterns = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
                ("access", "AKIA[A-Z0-9]+", 18, 0), ("hex", "[0-9a-f]+", 16, 0)]
    patterns[0] = (patterns[0][0], "(?:" + "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")" + patterns[0][1].split(")", 1)[1], 12, 1)
    n = 0
    for doc, text, _ in docs:
        spans = []
        for k, (kind, pattern, least, group) in enumerate(patterns):
            spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        r = rows[doc]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        base = [f"{kind}:{s}:{e}" for s, k, e, kind in sorted(spans)]
        assert r.base_sha256 == sha(",".join(base)) and set(base) <= set(r.spans.split(",")) | {""}
        n += len(base)
    assert n and len(rows) == len(docs)


def test_op5_base_measures(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op5")}
    for doc, text, _ in docs:
        words = WORD.findall(text)
        tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        n = Counter(tri)
        covered = {i + k for i, t in enumerate(tri) if n[t] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = rows[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)), doc
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.kept and r.base_failed)
    assert len(rows) == len(docs)


def test_op5_keeps_clean_documents(spark, duck):
    kept = {r.doc_id: r.kept for r in result(spark, "op5") if not r.base_failed}
    by = Counter((y, kept[d]) for d, y in duck.execute("SELECT doc_id, quality FROM labels").fetchall() if d in kept)
    print("op5 (quality, kept)", by)
    assert by[1, False] <= 0.02 * (by[1, False] + by[1, True])


def test_op6_components(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op6")}
    sets = {}
    for doc, text, _ in docs:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        sets[doc] = {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else ({tuple(words)} if words else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    pairs = Counter()
    for d, s in sets.items():
        for x in s:
            for e in holders[x]:
                if e > d:
                    pairs[d, e] += 1
    for (a, b), n in pairs.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    for d in sets:
        assert (rows[d].n_shingles, rows[d].component_id, rows[d].kept) == (len(sets[d]), find(d), find(d) == d), d
    assert len(rows) == len(docs) and len({find(d) for d in sets}) < len(sets)


def test_op7_key_law(spark, docs):
    rows = result(spark, "op7")
    text = {d: t for d, t, _ in docs}
    assert len(rows) == len(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 1000:
        moved = sum(r.grown_shard == 40 for r in rows)
        assert 0.4 * len(rows) / 41 < moved < 2 * len(rows) / 41 and len(slots) == 40


def test_op8_round_trip(spark, duck):
    turns = defaultdict(list)
    for conv, _, role, text in duck.execute("SELECT conv_id, turn, coalesce(role, ''), coalesce(text, '') FROM conversations ORDER BY conv_id, turn, role, text").fetchall():
        turns[conv].append((role, text))
    turns[-7] = [(r, r"\### Assistant: </turn> ok") for r in ("user", "assistant")]
    rows = {r.conv_id: r for r in result(spark, "op8")}
    assert set(rows) == set(turns)
    for conv, own in turns.items():
        r, loss = rows[conv], "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars >= sum(len(a) + len(b) for a, b in own)


def test_op9_removes_repeats(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op9")}
    seen: dict = {}
    removed = 0
    for doc, text, _ in docs:
        words = WORD.findall(text)
        gone, own = set(), []
        for i in range(len(words) - 12):
            w = tuple(words[i:i + 13])
            if w in seen:
                gone.update(range(i, i + 13))
            own.append(w)
        for w in own:
            seen.setdefault(w, doc)
        kept = [x for i, x in enumerate(words) if i not in gone]
        assert (rows[doc].n_words, rows[doc].n_removed, rows[doc].kept_sha256) == (len(words), len(gone), sha(" ".join(kept))), doc
        removed += len(gone)
    assert removed and len(rows) == len(docs)


def test_op10_fingerprints(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op10")}
    by_text = defaultdict(set)
    for i, (doc, text, _) in enumerate(docs):
        half, after = len(text) // 2, docs[(i + 1) % len(docs)][1]
        r = rows[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(text[:len(text) - half] + after[:half]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[text].add(r.fingerprint)
        assert r.near_edited == 1 or r.fingerprint != r.edited_fingerprint
    assert all(len(f) == 1 for f in by_text.values()) and len(rows) == len(docs)
    long = [r for r in rows.values() if r.n_chars >= 500]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.9 * len(long)


def test_pipeline(spark, docs):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= {d for d, _, _ in docs}
    filled = defaultdict(int)
    for r in rows:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    assert secrets.scan_text("password: hunter2hunter2") == [("assign", 0, 24)]


def spots(text):
    """Spot signatures as a plain set: (anchor, next content word, the one after or None), else (word,) of every word."""
    low = "".join(c.lower() if "A" <= c <= "Z" else " " if c in string.punctuation else c for c in text)
    words = WORD.findall(low) or WORD.findall(text)
    found = set()
    for i, w in enumerate(words):
        after = [x for x in words[i + 1:] if x not in spotsigs.COMMON][:2] if w in spotsigs.COMMON else []
        if after:
            found.add((w, after[0], after[1] if len(after) > 1 else None))
    return found or {(w,) for w in words}


def test_op10_sets_and_likeness(spark, docs):
    rows = {r.doc_id: r for r in result(spark, "op10")}
    own = [spots(text) for _, text, _ in docs]
    prints = {}
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, (doc, text, _) in enumerate(docs):
        half, k = len(text) // 2, (i + 1) % len(docs)
        edited, r = spots(text[:len(text) - half] + docs[k][1][:half]), rows[doc]
        assert (r.near_edited, r.near_next) == (jaccard(own[i], edited), jaccard(own[i], own[k])), doc
        for s, f in ((own[i], r.fingerprint), (edited, r.edited_fingerprint)):
            assert len(f) == 16 * len(s) and prints.setdefault(frozenset(s), f) == f
        pair = spotsigs.members(r.fingerprint), spotsigs.members(r.edited_fingerprint)
        assert spotsigs.likeness(*pair) == r.near_edited  # the two strings suffice
    assert len(set(prints.values())) == len(prints) and any(0 < r.near_edited < 1 for r in rows.values())


def one_of_each(rows):
    """The least id of each group linked by a Jaccard similarity of 0.8 of five-word shingles."""
    sets = {}
    for r in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        sets[r.doc_id] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            least, most = sorted((len(sets[a]), len(sets[b])))
            if a < b and group[a] != group[b] and 5 * least >= 4 * most and least and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {d: x if g == y else g for d, g in group.items()}
    return [(r.doc_id, r.text) for r in rows if group[r.doc_id] == r.doc_id]


def redact(text):
    out, done = "", 0
    for s, e in sorted((s, e) for _, s, e in secrets.scan_text(text or "")):
        if s >= done:
            out += text[done:s] + "[secret]"
        done = max(done, e)
    return out + text[done:] if done else text


def mix(rows):
    """The copies taken: 1.5 times all words, dealt by weight up to twice a source, in order of md5 of the id."""
    by_source, out = defaultdict(list), []
    for r in rows:
        by_source[r.source].append((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id, r.text, WORD.findall(r.text or "")))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.CYCLE[i % len(mixing.CYCLE)] for i, s in enumerate(names)}
    size = {s: sum(len(d[3]) for d in by_source[s]) for s in names}
    left, free, target = 1.5 * sum(size.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * size[s] < level * weight[s]}
        for s in full or free:
            target[s] = 2.0 * size[s] if full else level * weight[s]
        left, free = left - sum(target[s] for s in full), free - full if full else set()
    for s in names:
        words = int(target[s] + 0.5)
        while words:
            for _, doc, text, own in sorted(by_source[s], key=lambda d: (d[0], d[1], len(d[3]))):
                if own and words:
                    out.append((doc, text if len(own) <= words else " ".join(own[:words])))
                    words -= min(words, len(own))
    return out


def pieces(rows):
    tokenizer, out = Tokenizer.from_file(TOKENIZER), []
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        at = 0
        for k in range(-(-len(ids) // 1024)):
            n = 1024 if k else len(ids) % 1024 or 1024
            out.append((r.doc_id, k, at, n, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at:at + n]))))
            at += n
    return out


def plain_toxicity(model, text):
    """Score and number of toxic tokens of one text, token by token: forward-backward, the three aggregates, the logistic."""
    import math
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", text)]
    psi = [math.exp(min(30, max(-30, model.bias + sum(model.weights.get(f, 0.0) for f in ["=" + w] + [w[:k] for k in range(3, 10) if len(w) >= k])))) for w in words]
    forward, backward = [], []
    for i, x in enumerate(psi):
        clean, toxic = model.start if i == 0 else [sum(forward[-1][a] * model.trans[a][b] for a in (0, 1)) for b in (0, 1)]
        total = clean + toxic * x
        forward.append((clean / total, toxic * x / total))
    after = (1.0, 1.0)
    for i in reversed(range(len(psi))):
        backward.append(after)
        step = [model.trans[a][0] * after[0] + model.trans[a][1] * psi[i] * after[1] for a in (0, 1)]
        after = (step[0] / sum(step), step[1] / sum(step))
    p = [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(forward, reversed(backward))]
    aggregates = [1.0, math.log1p(sum(p)), math.log((sum(p) + 0.2) / (len(p) + 50)) + 5, max(p, default=0.0)]
    return 1 / (1 + math.exp(-sum(a * w for a, w in zip(aggregates, model.logistic)))), sum(x >= 0.5 for x in p)


def test_op2_against_plain_forward_backward(spark, duck, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    assert len(model.weights) > 3
    rows = {r.doc_id: r for r in result(spark, "op2")}
    for doc, text, _ in docs:
        score, toxic = plain_toxicity(model, text)
        assert abs(rows[doc].score - score) < 1e-6 and rows[doc].held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert rows[doc].predicted == (rows[doc].score >= 0.3) and rows[doc].n_toxic == toxic
    assert any(r.n_toxic for r in rows.values())


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(rows, spark.read.parquet(f"{SF}/labels.parquet"))
    def clean(own):
        return [(r.doc_id, r.text) for r in own if plain_toxicity(model, r.text or "")[0] < 0.3]
    plain = [clean, one_of_each, lambda own: [(r.doc_id, redact(r.text)) for r in own], mix, pieces]
    key = lambda r: tuple(("", x) if isinstance(x, str) else (str(x is None), x or 0) for x in r)
    changed = []
    for k, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        own = rows.collect()
        stage(spark, rows, SF).write.parquet(str(tmp_path / str(k)))
        rows = spark.read.parquet(str(tmp_path / str(k)))
        columns = ["doc_id", "text"] if k < 4 else ["doc_id", "piece", "start", "length", "ids_crc32"]
        got = [tuple(r[c] for c in columns) for r in rows.collect()]
        assert sorted(got, key=key) == sorted(expected(own), key=key), name
        changed.append(sorted(got, key=key) != sorted([(r.doc_id, r.text) for r in own], key=key))
    assert all(changed)
    by_sequence = defaultdict(list)
    for r in rows.collect():
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert all(o == sum(n for _, n in sorted(own)[:i]) and o + n <= 1024 for own in by_sequence.values() for i, (o, n) in enumerate(sorted(own)))


def test_op13_against_all_pairs(spark, docs):
    import xxhash
    prints = {}
    for doc, text, _ in docs:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = WORD.findall(words)
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    component = {d: d for d in prints}

    def root(d):
        while component[d] != d:
            d = component[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                component[y] = x
    rows = result(spark, "op13")
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((d, f"{prints[d]:016x}", root(d)) for d in prints)
    assert len({r.component_id for r in rows}) < len(rows)
