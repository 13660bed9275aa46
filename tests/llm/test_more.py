"""Operators 11 to 13 against plain versions, and odd rows."""

import collections
import hashlib
import heapq
import itertools
import random
import re
import zlib

import pyarrow as pa
import pytest

from tallyloom.llm import collocations, common, conversations, token_counts

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


# --- 12: conversations


def plain_audit(rows):
    """(cost, audit) of rows (initial, fault): all edits by rising cost and then by ASCII, no bound and no table."""
    todo = [(0, "", 0, "")]
    while todo:
        cost, audit, i, out = heapq.heappop(todo)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit
        if not re.fullmatch("s?(ua)*u?", out):
            continue
        for role in "ua":
            todo_cost = cost + 2
            heapq.heappush(todo, (todo_cost, audit + "I", i, out + role))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(todo, (cost + 3, audit + "D", i + 1, out))
            if fault != "gone":
                extra = fault == "cut"
                heapq.heappush(todo, (cost + extra, audit + "K", i + 1, out + initial))
                for role in "ua":
                    heapq.heappush(todo, (cost + 2 + extra, audit + "R", i + 1, out + role))


def plain_conversation(rows):
    """The result for damaged rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = plain_audit([(r[:1] or "none", {"blank": "gone", "duplicate": "gone", "truncated": "cut", "": ""}[f]) for (_, r, _), f in zip(rows, faults, strict=True)])
    turns = {t for t, _, _ in rows if t is not None}
    out, i = [], 0
    for edit in audit:
        due = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((due, ""))
            continue
        if edit in "KR":
            out.append((rows[i][1] if edit == "K" else due, rows[i][2]))
        i += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), out


def plain_damage(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def in_order(rows):
    same = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), same(x[1], x[2])))


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(1)
    letters = {**{c: (c, "") for c in "suax"}, **{c: (c.lower(), "cut") for c in "SUAX"}, **{str(k): ("suax"[k], "gone") for k in range(4)}}
    for n in range(7):
        for _ in range(30):
            codes = "".join(rng.choice("suauaUAax01S3") for _ in range(n))
            assert conversations.solve(codes.encode(), True, True)[0][2:4] == plain_audit([letters[c] for c in codes]), codes


def test_blocks_give_what_the_whole_gives():
    import pandas as pd

    rng = random.Random(2)
    for n, size in [(7, 1), (40, 3), (41, 8), (300, 7)]:
        for _ in range(20):
            codes = "".join(rng.choice("suuaauaUAx02") for _ in range(n)).encode()
            whole = conversations.solve(codes, True, True)[0]
            cuts = range(0, n, size)
            ways = [(1, 0, k, *w) for k in cuts for w in conversations.solve(codes[k : k + size], k == 0, k + size >= n)]
            frame = pd.DataFrame(ways, columns=["conv_id", "part", "seq", "begin", "end", "cost", "audit", "place"])
            best = conversations.choose(frame.sample(frac=1, random_state=n)).merge(frame, on=["part", "seq", "begin", "end"])
            assert (best["cost"].sum(), "".join(best["audit"])) == whole[2:4]


def test_search_of_a_long_conversation_is_linear():
    import time

    began = time.time()
    codes = ("su" * 3 + "aaU0xuuuuuA" * 20_000).encode()
    cost, audit = conversations.solve(codes, True, True)[0][2:4]
    assert len(audit) >= len(codes) and cost > 0 and time.time() - began < 20


def test_conversation_repair(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(9001, None, None, None), (9001, None, "user", "Hi there."), (9001, 2, "", "x"), (9001, 2, "tool", "é? "), (9002, 0, "user", ""), (None, 1, "user", "Who?"), (None, 2, "assistant", "I. "), (None, None, "system", "S.")]
    rows += [(9003, k, "user", "Same again.") for k in range(5)] + [(9003, 3, "user", "Same again.")] * 2 + [(9004, 7, "assistant", "Zz!"), (9004, 7, "assistant", "A."), (9004, 7, "user", "B.")]
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, same string, kind int")
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]] += plain_damage(*r)
    expected = {c: plain_conversation(in_order(x)) for c, x in by.items()}
    for block in (conversations.BLOCK, 2):
        got = [tuple(r) for r in conversations.repair(conversations.damage(frame), frame.select("conv_id", "turn", "role", "text"), block).collect()]
        assert len(got) == len(expected)
        assert {g[0]: g[1:] for g in got} == {c: e[0] for c, e in expected.items()}
    made = collections.defaultdict(list)
    for r in sorted(conversations.repair(conversations.damage(frame), texts=True).collect(), key=lambda r: r["place"]):
        made[r["conv_id"]].append((r["role"], r["text"]))
    assert dict(made) == {c: e[1] for c, e in expected.items() if e[1]}
    empty = frame.where("false")
    assert conversations.repair(conversations.damage(empty), empty).collect() == []


def test_conversation_of_many_rows_spreads_over_tasks(spark):
    from pyspark.sql import functions as F

    n = 5000
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), "id", F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id") % 4998, F.lit(".")).alias("text")).withColumnRenamed("id", "turn")
    each = conversations.coded(conversations.with_digest(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are put together again
    try:
        cut = conversations.blocks_of(each, 500)
        assert cut.select("part").distinct().count() > 1 and cut.count() >= 10
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = conversations.repair(rows, block=500).collect()[0]
    plain = [(k, "user" if k % 3 == 0 else "assistant", f"t{k % 4998}.") for k in range(n)]
    codes = "".join("u" if k % 3 == 0 else "a" for k in range(n - 2)) + "12"
    assert (got["cost"], got["audit"]) == conversations.solve(codes.encode(), True, True)[0][2:4]
    assert got["duplicate"] == 2 and got["illegal"] == sum(a[1][:1] == b[1][:1] for a, b in itertools.pairwise(plain))


# --- 11: collocations


def plain_phrases(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 6):
                for k in range(len(w) - size + 1):
                    f[lang, tuple(w[k : k + size])] += 1
    kept = {k: v for k, v in f.items() if v >= least}
    best = collections.defaultdict(list)
    for (lang, w), a in kept.items():
        if len(w) > 1 and not any(v * 100 >= a * 100 and x == lang and len(y) > len(w) and any(y[k : k + len(w)] == w for k in range(len(y))) for (x, y), v in kept.items()):
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            best[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in best.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


ODD_TEXTS = [(None, "one two ONE two"), ("en", None), ("en", ""), ("en", "  \t. ,;"), ("en", "É é\x00 b, É é\x00 b"), ("en", "x" * 70_000), ("de", "ha " * 60_000), ("de", "eins zwei drei vier fünf sechs sieben " * 300), ("de", "eins zwei drei vier fünf sechs sieben " * 300)]


def test_collocations_equal_all_phrases(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").limit(60).collect()] + ODD_TEXTS + [("en", "alpha beta gamma. delta")] * 50 + [("en", "alpha\tbeta  gamma, alpha beta")] * 7
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, own int, chunk string")
    for least, top, most in [(2, 50, collocations.MOST), (4, 2000, 0), (3, 7, 40)]:
        got = sorted(tuple(r) for r in collocations.collocations(frame, least, top=top, most=most).collect())
        assert got == plain_phrases(rows, least, top)
    assert collocations.collocations(frame.where("false")).collect() == []


def test_chunks_are_prefix_free_and_shared():
    rng = random.Random(3)
    vocabulary = ["w%d" % k for k in range(40)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(3000))
    texts = [passage, "other words first " + passage, passage + " and then"]
    data, at = common.buffers(pa.array(texts))
    chunks, own, words, owner = collocations.chunks_of(data, at)
    assert sum(own) == sum(len(t.split()) for t in texts)
    for k, c in enumerate(chunks[:-1]):
        if owner[k] == owner[k + 1]:
            assert c.split()[-collocations.TRIGGER :] == chunks[k + 1].split()[: collocations.TRIGGER]  # neighbours share a trigger
            assert words[k] == own[k] + collocations.TRIGGER
    assert len(set(chunks)) < 0.5 * len(chunks)


# --- 13: token counts


def test_token_counts_equal_the_library(spark):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    texts = [None, "", " ", "one", "It's <|endoftext|> ÀÉß 東京 don't 12ab ½", "<|endoftext|>", "x" * 5000, "La casa es azul y grande. " * 400, "a\n\n b  c \x00 d", "东京很大。" * 900 + "end", "，。！？" * 50, " 　  " * 80, "'s'll 'd " * 200, "<s> a <unk>  b ▁ c"]
    rng = random.Random(5)
    texts += ["".join(rng.choice("ab é中。，' \n\t1<|>𝄞́") for _ in range(rng.randrange(600))) for _ in range(60)]
    rows = [*enumerate(texts), (3, "one"), (None, "no id")]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    plain = common.texts(frame)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = P.path(name)
        if name.endswith("json"):
            t = Tokenizer.from_file(path)
            count = lambda x: len(t.encode(x, add_special_tokens=False).ids)  # noqa: B023, E731
        else:
            t = SentencePieceProcessor(model_file=path)
            count = lambda x: len(t.encode(x))  # noqa: B023, E731
        expected = sorted(((i, len((x or "").encode()), count(x or ""), count(x or "") > 100) for i, x in rows), key=str)
        for size in (token_counts.BATCH_BYTES, 64, 7):
            got = sorted((tuple(r) for r in token_counts.count_tokens(plain, path, 100, size).collect()), key=str)
            assert got == expected, (name, size)
    assert token_counts.count_tokens(plain.where("false"), P.path("byte_bpe_50k.json")).collect() == []


def test_batches_are_of_like_bytes():
    column = pa.array(["word " * 40_000, "a", "b c", "x" * 3000, *["short text"] * 900])
    sizes = [len(data) for _, data, _, _ in token_counts.batches(column, 1000, token_counts.byte_level_cuts)]
    assert sum(sizes) == sum(len(x.as_py()) for x in column)
    assert sum(s > 1000 for s in sizes) == 1 and sorted(sizes)[len(sizes) // 2] > 900  # all but the word of 3,000 letters
