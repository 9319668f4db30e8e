"""Duplicate operators against brute force."""

from __future__ import annotations

import collections
import hashlib
import re

import pytest

from keeprate.llm import lines, minhash, suffixes, windows

LAST = (1 << 63) - 1


def key_of(doc_id):
    return LAST if doc_id is None else doc_id


def check_rows(result, wanted):
    """Rows as multisets of (doc_id, ...) tuples."""
    got = collections.Counter(tuple(r) for r in result.collect())
    assert got == collections.Counter(wanted)


def test_windows_match_brute_force(spark, corpus, rows):
    first = {}
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        for s in range(len(w) - 19):
            k, place = tuple(w[s:s + 20]), (key_of(doc_id), s)
            first[k] = min(first.get(k, place), place)
    wanted = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (key_of(doc_id), s):
                gone.update(range(s, s + 20))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        wanted.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    assert sum(x[2] for x in wanted) > 500
    check_rows(windows.digest(windows.dedup(spark, corpus)), wanted)


@pytest.mark.parametrize("bucket", [3_000_000, 200])
def test_windows_do_not_depend_on_buckets(spark, corpus, rows, bucket, monkeypatch):
    whole = windows.digest(windows.dedup(spark, corpus)).collect()
    monkeypatch.setattr(windows, "BUCKET_WINDOWS", bucket)
    monkeypatch.setattr(windows.rolling, "CHUNK_BYTES", 700)
    assert sorted(map(str, windows.digest(windows.dedup(spark, corpus)).collect())) == sorted(map(str, whole))


def brute_suffixes(rows, least=200):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = collections.Counter(x[s:s + least] for _, x in raw for s in range(len(x) - least + 1))
    wanted = []
    for doc_id, x in raw:
        covered = bytearray(len(x))
        for s in range(len(x) - least + 1):
            if count[x[s:s + least]] > 1:
                covered[s:s + least] = b"\x01" * least
        runs = len(re.findall(b"\x01+", bytes(covered)))
        kept = bytes(b for b, c in zip(x, covered) if not c)
        wanted.append((doc_id, len(x), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return wanted


@pytest.mark.parametrize("hot", [30_000, 2])
def test_suffixes_match_brute_force(spark, corpus, rows, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    wanted = brute_suffixes(rows)
    assert sum(x[2] for x in wanted) > 5_000
    check_rows(suffixes.digest(suffixes.dedup(spark, corpus)), wanted)


def test_suffixes_of_other_lengths(spark, corpus, rows):
    check_rows(suffixes.digest(suffixes.dedup(spark, corpus, least=90)), brute_suffixes(rows, 90))
    with pytest.raises(ValueError):
        suffixes.dedup(spark, corpus, least=10)


def shingles(text, width):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_groups(rows, width, least, per):
    sets = [shingles(t, width) for _, t, *_ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and per * both >= least * (len(sets[a]) + len(sets[b]) - both):
                group[root(a)] = root(b)
    smallest = collections.defaultdict(lambda: LAST)
    for i, (doc_id, *_) in enumerate(rows):
        smallest[root(i)] = min(smallest[root(i)], key_of(doc_id))
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        component = smallest[root(i)]
        out.append((doc_id, len(sets[i]), None if component == LAST else component, key_of(doc_id) == component))
    return out


@pytest.mark.parametrize("width,least", [(3, 85), (5, 80)])
def test_groups_match_brute_force(spark, corpus, rows, width, least):
    wanted = brute_groups(rows, width, least, 100)
    assert sum(not x[3] for x in wanted) > 10
    check_rows(minhash.group(spark, corpus, width, least, 100).drop("text_hash"), wanted)


def test_one_of_each_group_stays(spark, corpus, rows):
    kept = minhash.dedup(spark, corpus)
    assert kept.columns == corpus.columns
    wanted = [(r[0], r[1]) for r, x in zip(rows, brute_groups(rows, 5, 80, 100)) if x[3]]
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter(wanted)


def test_pairs_that_have_met_do_not_meet_again(spark, monkeypatch):
    words = [f"w{i}" for i in range(8_000)]
    rows = [(2 * i + half, " ".join(words[200 * i + 15 * half:200 * i + 15 * half + 100])) for i in range(40) for half in (0, 1)]
    met, meetings = [], minhash._meetings

    def counted(texts, *settings):
        met.append(texts.count())
        return meetings(texts, *settings)

    monkeypatch.setattr(minhash, "_meetings", counted)
    found = minhash.group(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(r.kept for r in found.collect())  # 81 of 111 shingles: they share buckets of two, and are no copies
    assert met == [0]


def test_pruning_limits_follow_the_posterior():
    limits = minhash.least_matches(0.85)
    assert limits == sorted(limits) and len(limits) == minhash.HASHES // minhash.BATCH
    assert limits[-1] < 0.85 * minhash.HASHES


def brute_lines(rows, min_words=10):
    first = {}
    split = [(i, None if t is None else t.split("\n")) for i, t, *_ in rows]
    for doc_id, parts in split:
        for size in (1, 2, 4, 8, 16):
            for p in range(len(parts or []) - size + 1):
                k, place = tuple(parts[p:p + size]), (key_of(doc_id), p)
                first[k] = min(first.get(k, place), place)
    out = []
    for doc_id, parts in split:
        gone = set()
        for size in (1, 2, 4, 8, 16):
            for p in range(len(parts or []) - size + 1):
                block = parts[p:p + size]
                n = sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in block)
                if n >= min_words and first[tuple(block)] < (key_of(doc_id), p):
                    gone.update(range(p, p + size))
        out.append((doc_id, None if parts is None else "\n".join(x for i, x in enumerate(parts) if i not in gone), len(gone)))
    return out


def test_lines_match_brute_force(spark, corpus, rows):
    found = lines.dedup(spark, corpus, removed_name="gone", kept_name="rest", whole_runs=False)
    got = collections.Counter((r.doc_id, r.rest, sum(x.end - x.start for x in r.gone)) for r in found.collect())
    wanted = brute_lines(rows)
    assert sum(x[2] for x in wanted) > 20
    assert got == collections.Counter(wanted)


def brute_runs(rows, min_words=10):
    """Lines of the longest run from each line that also starts at an earlier place."""
    at, out = collections.defaultdict(list), []
    split = [(i, None if t is None else t.split("\n")) for i, t, *_ in rows]
    for doc_id, parts in split:
        for p, line in enumerate(parts or []):
            at[line].append(((key_of(doc_id), p), parts))
    for doc_id, parts in split:
        gone = set()
        for p in range(len(parts or [])):
            best = 0
            for (key, q), other in at[parts[p]]:
                if (key, q) < (key_of(doc_id), p):
                    n = 0
                    while p + n < len(parts) and q + n < len(other) and parts[p + n] == other[q + n]:
                        n += 1
                    best = max(best, n)
            if sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in parts[p:p + best]) >= min_words:
                gone.update(range(p, p + best))
        out.append((doc_id, None if parts is None else "\n".join(x for i, x in enumerate(parts) if i not in gone), len(gone)))
    return out


def check_runs(spark, docs, rows):
    found = lines.dedup(spark, docs, removed_name="gone", kept_name="rest", whole_runs=True)
    got = collections.Counter((r.doc_id, r.rest, sum(x.end - x.start for x in r.gone)) for r in found.collect())
    assert got == collections.Counter(brute_runs(rows))


def test_whole_runs_match_brute_force(spark, corpus, rows):
    assert brute_runs(rows) != brute_lines(rows)
    check_runs(spark, corpus, rows)


def test_whole_runs_of_short_lines_go(spark):
    say = lambda at, n: " ".join(f"w{at}x{i}" for i in range(n))
    runs = [
        "\n".join(say(i, 1) if i % 2 == 0 else "" for i in range(400)),  # 200 words, any 16 lines hold 8
        "\n".join(say(1000 + i, 4) for i in range(3)),
        say(2000, 9) + "\n\n" + say(2001, 9),
        "\n".join(say(3000 + i, 2) for i in range(7)),
        say(4000, 20) + "\n\n" + say(4001, 9),
    ]
    rows = [(10 * n + c, f"top {n} {c}\n{run}\nend {n} {c}") for n, run in enumerate(runs) for c in range(3)]
    rows += [(90, "top\n" + say(1000, 4) + "\n" + say(1001, 4) + "\nend")]  # eight words of a run: too few
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_runs(spark, docs, rows)
    left = {r.doc_id: r.text for r in lines.without_repeats(spark, docs, whole_runs=True).collect()}
    assert all(left[10 * n + c] == f"top {n} {c}\nend {n} {c}" for n in range(len(runs)) for c in (1, 2))
    assert left[90] == rows[-1][1]


def test_line_stage_keeps_columns(spark, corpus, rows):
    out = lines.without_repeats(spark, corpus)
    assert out.columns == corpus.columns
    assert 0 < out.count() < corpus.count()


def test_small_rounds_go_to_few_files(spark, corpus, rows, monkeypatch):
    files, settled = {}, lines.settled

    def counted(df, name, *about):
        out = settled(df, name, *about)
        files[name] = len(out.inputFiles())
        return out

    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    monkeypatch.setattr(lines, "settled", counted)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = lines.dedup(spark, corpus).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == len(rows)
    assert len(files) > 5 and all(n == 1 for name, n in files.items() if name != "lines"), files


def test_whole_runs_of_an_empty_table(spark, nothing):
    assert lines.dedup(spark, nothing, whole_runs=True).count() == 0


def test_empty_tables(spark, nothing):
    assert windows.dedup(spark, nothing).count() == 0
    assert suffixes.dedup(spark, nothing).count() == 0
    assert minhash.group(spark, nothing).count() == 0
    assert minhash.dedup(spark, nothing).columns == nothing.columns
    assert lines.dedup(spark, nothing).count() == 0
    assert lines.without_repeats(spark, nothing).count() == 0


def thue(size: int) -> tuple[str, str]:
    """Two words of a pattern that polynomial hashes modulo 2^64 cannot tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1_024, 4_096])
def test_patterned_words_differ(spark, size):
    one, other = thue(size)
    words = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{one} {words}"), (2, f"{other} {words}"), (3, one), (4, other)], "doc_id long, text string")
    assert {r.doc_id: r.removed for r in windows.dedup(spark, docs).collect()} == {i: [] for i in range(1, 5)}
    found = {r.doc_id: r.component_id for r in minhash.group(spark, docs, 3, 85, 100).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}  # the first two share 17 of 19 shingles


def test_many_rows_of_one_id_or_none(spark):
    """Different texts under no id, or under one, keep apart, and their groups are spread over the tasks."""
    passage = " ".join(f"shared{i}" for i in range(40))
    texts = [f"text {i} " + ("x" * (i % 50)) + (f" {passage} end {i}" if i % 100 == 0 else "") for i in range(3_000)]
    for doc_id in (None, 7):
        rows = [(doc_id, t) for t in texts] + [(1, passage)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        want = sorted((passage in t and (doc_id is None or doc_id > 1), len(t.split())) for t in texts)
        got = [r for r in windows.dedup(spark, docs).collect() if r.doc_id != 1]
        assert sorted((bool(r.removed), r.n_words) for r in got) == want
        assert all(r.kept in texts or passage not in r.kept for r in got)
        cut = suffixes.dedup(spark, docs).collect()
        assert sum(bool(r.removed) for r in cut) == 31
        assert all(bytes(r.kept).decode() in texts or b"shared1 " not in bytes(r.kept) for r in cut)
        named = windows.identified(docs)
        assert named.withColumn("g", windows.grouped_by(7)).groupBy("g").count().count() == 7


def test_only_short_texts(spark):
    docs = spark.createDataFrame([(i, f"a short text of some thirty bytes {i}") for i in range(20)], "doc_id long, text string").coalesce(1)
    assert all(not r.removed for r in suffixes.dedup(spark, docs).collect())
