"""Document fingerprints, the Merkle manifest and conversation repair against brute force on
small tables with nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import collections
import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tastemap.llm import merkle, piecewise, repair

rng = random.Random(5)
MASK = (1 << 64) - 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


# Fingerprints ------------------------------------------------------------------------------
def mix(x):
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & MASK
    return x ^ (x >> 32)


def plain_fingerprint(data):
    padded, n, level = b"\0" * 7 + data, len(data), 2
    trigger = [mix(int.from_bytes(padded[p:p + 8], "little") * 0xC2B2AE3D27D4EB4F & MASK) >> 24 for p in range(n)]
    while n // 64 >= 1 << level:
        level += 1

    def signature(k):
        out, start = "", 0
        for end in range(1, n + 1):
            size = end - start
            if end == n or size == 4 << k or (size >= max(1, (1 << k) // 8) and trigger[end - 1] % (1 << k) == 0):
                value = sum((data[start + i] + 1) * pow(piecewise._BASE, i, 1 << 64) for i in range(size)) + size & MASK
                out += piecewise._CHUNK[mix(value) >> 52]
                start = end
        return out
    return f"{1 << level}:{signature(level)}:{signature(level + 1)}"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_fingerprint_matches_plain_python(monkeypatch):
    texts = [b"", b"a", b"ab" * 700, b"x" * 3000, prose(1500).encode(), prose(40).encode(), bytes(range(256)) * 9]
    want = [plain_fingerprint(t) for t in texts]
    assert [piecewise.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(piecewise, "SLICE", 512)  # chunks and windows that cross slices
    assert [piecewise.fingerprint(t) for t in texts] == want


def test_edit_distance_and_likeness():
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in range(2))
        assert piecewise.edit_distance(a, b) == plain_distance(a, b)
    text = prose(800)
    one, near = piecewise.fingerprint(text.encode()), piecewise.fingerprint((text[:2000] + "changed" + text[2000:]).encode())
    longer = piecewise.fingerprint((text + " " + prose(800)).encode())  # next block size
    assert piecewise.likeness(one, one) == 1 and piecewise.likeness(one, near) > 0.9
    assert one.split(":")[0] != longer.split(":")[0] and piecewise.likeness(one, longer) > 0.4
    assert piecewise.likeness(one, piecewise.fingerprint(prose(800).encode())) < 0.2
    assert piecewise.likeness(one, "4::") == 0


@pytest.fixture(scope="module")
def docs_rows():
    base = prose(300)
    texts = [base, base, None, "", " \n", "a", "ab" * 700, "É" * 900, prose(3000), base + " " + prose(40), prose(7)]
    made = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, None), (3, ""), (3, ""), (3, "other"), (0, base)]
    made += [(100 + k, prose(rng.randint(1, 30))) for k in range(120)]
    langs = ["en"] * 9 + ["de", None, "", "ß"]
    return [(i, t, langs[k % 13], None if k % 7 == 0 else f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(made)] \
        + [(900, "lone", "xx", "s", 4)]


@pytest.fixture(scope="module")
def docs(spark, docs_rows):
    df = spark.createDataFrame(docs_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    return df.withColumns({"leaf": F.lit("x"), "rank": F.lit(1), "digest": F.lit(2), "bucket": F.lit(3), "id": F.lit("y")})


def test_fingerprint_pairs(spark, docs_rows, docs):
    rows = sorted(((i, sha(t or ""), t or "") for i, t, *_ in docs_rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    want = collections.Counter()
    for k, (i, _, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][2]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        fp, efp, nfp = (piecewise.fingerprint(x.encode()) for x in (t, edited, nxt))
        want[(i, len(t), sha(edited), fp, efp, piecewise.likeness(fp, efp), piecewise.likeness(fp, nfp))] += 1
    assert collections.Counter(map(tuple, piecewise.fingerprint_pairs(docs).collect())) == want
    one = piecewise.fingerprint_pairs(docs.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert piecewise.fingerprint_pairs(docs.limit(0)).collect() == []


# Merkle manifest ---------------------------------------------------------------------------
def plain_manifest(rows):
    """(doc_id, leaf) -> proofs of plain recursion over lists, and the root."""
    def leaf(i, text, lang, source, n):
        told = (i, source, lang, n, text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))

    def climb(nodes):  # nodes: (digest, [members]); member: {"path": [...]}
        while len(nodes) > 1:
            up = []
            for k in range(0, len(nodes), 8):
                run = nodes[k:k + 8]
                for j, (_, members) in enumerate(run):
                    for m in members:
                        m["path"].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1:])))
                up.append((sha("".join(d for d, _ in run)), [m for _, ms in run for m in ms]))
            nodes = up
        return nodes[0]
    by_lang = collections.defaultdict(list)
    for i, text, lang, source, n in rows:
        lowered = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        d = leaf(i, text, lang, source, n)
        by_lang[lang].append((i is not None, i or 0, d, {"id": i, "leaf": d, "path": [],
                                                         "shown": leaf(i, lowered, lang, source, n) if tampered else d}))
    subroots = []
    for lang in sorted(by_lang, key=lambda x: (x is not None, (x or "").encode())):
        digest, members = climb([(d, [m]) for _, _, d, m in sorted(by_lang[lang], key=lambda r: r[:3])])
        for m in members:
            m["subroot"] = digest
        subroots.append((digest, members))
    root, members = climb(subroots)
    out = collections.Counter()
    for m in members:
        folded = m["shown"]
        for left, right in m["path"]:
            folded = sha(left + folded + right)
        out[(m["id"], m["leaf"], m["subroot"], root, sha("".join(a + b for a, b in m["path"])), folded, folded == root)] += 1
    return out


def merkle_rows(spark, df, tmp_path):
    df.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return collections.Counter(map(tuple, merkle.op12_merkle_manifest(spark, str(tmp_path)).collect()))


def test_merkle_manifest(spark, docs_rows, docs, tmp_path):
    assert merkle_rows(spark, docs, tmp_path / "all") == plain_manifest(docs_rows)
    one_lang = [r for r in docs_rows if r[2] == "de"]
    assert merkle_rows(spark, docs.where("lang = 'de'"), tmp_path / "one") == plain_manifest(one_lang)
    lone = [r for r in docs_rows if r[0] == 900]
    assert merkle_rows(spark, docs.where("doc_id = 900"), tmp_path / "lone") == plain_manifest(lone)
    assert not merkle_rows(spark, docs.limit(0), tmp_path / "none")


def test_merkle_equal_rows_and_some_requests(spark):
    same = [(1, "same text", "en", "s", 9)] * 200  # equal nodes: one record each
    df = spark.createDataFrame(same + [(2, "x", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    manifest = merkle.build_manifest(df)
    assert merkle._records(manifest.levels[0]).count() < manifest.levels[0].count()
    asked = manifest.leaves.where("rank in (0, 77, 200)").select("lang", "rank", "digest")
    unknown = asked.limit(1).select("lang", F.lit(5000).cast("long").alias("rank"), "digest")
    found = merkle.proofs(manifest, asked.unionByName(unknown)).select(
        "rank", merkle.fold_path(F.lower(F.hex("digest")), F.col("path")).alias("root")).collect()
    assert sorted(r["rank"] for r in found) == [0, 77, 200] and {r["root"] for r in found} == {manifest.root.hex()}


# Conversation repair -----------------------------------------------------------------------
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_edits(rows):
    """Least (cost, letters, repaired rows) by plain recursion over (row, state)."""
    @functools.cache
    def best(i, state):  # state: 0 nothing, 1 after s, 2 after u, 3 after a
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        follow = 3 if state == 2 else 2
        role = "assistant" if state == 2 else "user"
        if i < len(rows):
            r, t, must, cut = rows[i]
            later = [("D", 2, state, ())]
            if not must:
                if r[:1] == "s" and state == 0:
                    later.append(("K", 5 * cut, 1, ((r, t),)))
                if r[:1] == role[0]:
                    later.append(("K", 5 * cut, follow, ((r, t),)))
                later.append(("R", 1 + 5 * cut, follow, ((role, t),)))
            for letter, cost, to, out in later:
                c, s, o = best(i + 1, to)
                options.append((cost + c, letter + s, out + o))
        for n in (1, 2):  # up to two insertions before the next row
            to, out, states = state, (), state
            for _ in range(n):
                out += (("assistant" if states == 2 else "user", ""),)
                states = 3 if states == 2 else 2
            if i == len(rows):
                if states == 3:
                    options.append((5 * n, "I" * n, out))
            else:
                r, t, must, cut = rows[i]
                role2, follow2 = ("assistant", 3) if states == 2 else ("user", 2)
                if not must:
                    if r[:1] == role2[0]:
                        c, s, o = best(i + 1, follow2)
                        options.append((5 * n + 5 * cut + c, "I" * n + "K" + s, out + ((r, t),) + o))
                    c, s, o = best(i + 1, follow2)
                    options.append((5 * n + 1 + 5 * cut + c, "I" * n + "R" + s, out + ((role2, t),) + o))
                c, s, o = best(i + 1, states)
                options.append((5 * n + 2 + c, "I" * n + "D" + s, out + o))
        return min(options)
    return best(0, 0)


def plain_repair(rows):
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv]
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        by_conv[conv] += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    out = collections.Counter()
    for conv, found in by_conv.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, faults = set(), [], collections.Counter()
        for _, role, text in found:
            chars = WORD.findall(text)
            fault = "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            codes.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, *_ in found if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, left = plain_edits(tuple(codes))
        out[(conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"],
             faults["truncated"], illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left)))] += 1
    return out


def repaired(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    df = df.withColumns({"copy": F.lit(9), "fault": F.lit("z"), "digest": F.lit(1), "dropped": F.lit("q")})
    return collections.Counter(map(tuple, repair.repair_conversations(repair.damage(df)).collect()))


def test_cheapest_edits_match_recursion():
    for _ in range(300):
        rows = tuple((rng.choice(["system", "user", "assistant", "tool"]), "x", rng.random() < 0.2, rng.random() < 0.3)
                     for _ in range(rng.randint(0, 12)))
        codes = bytes(repair._OF_INITIAL.get(r[0], 0) | (4 if must else 8 * cut) for r, _, must, cut in rows)
        rows = tuple((r, t, must, cut and not must) for r, t, must, cut in rows)
        assert repair.cheapest_edits(codes) == plain_edits(rows)[:2]


def test_repair_conversations(spark):
    texts = ["Hello.", "Hello", "", " \t", None, "Why?", "Yes!\n ", "é…", "a.b", " ", "x" * 3000 + "."]
    rows = []
    for conv in list(range(80)) + [None]:
        for k in range(rng.randint(1, 9)):
            rows.append((conv, None if rng.random() < 0.1 else k + 3 * (rng.random() < 0.1),
                         rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool"]), rng.choice(texts)))
    rows += rows[:40]  # repeated rows and equal turns
    rows += [(1000, k, "user" if k % 2 == 0 else "assistant", f"text {k % 700}.") for k in range(900)]  # one long conversation
    rows.append(next((c, 0, "user", "gone.") for c in range(2000, 2100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0))
    got = repaired(spark, rows)
    assert got == plain_repair(rows)
    assert any(r[7] == "" and r[0] is not None and r[0] >= 2000 for r in got)


def test_repair_spools_to_scratch_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(repair, "SPOOL_BYTES", 64)
    one = repair._Conversation(1)
    for turn in range(50):
        one.add(turn, "user" if turn % 2 == 0 else "assistant", "t" * 30 + ".", "")
    assert one.close()[6:8] == (0, "K" * 50)
    assert repaired(spark, [(1, 1, "user", "x")][:0]) == collections.Counter()
