import gzip
import hashlib
import io
import random

import pytest

from catalog_sync.llm import chat, registered, warc
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|image|>", "<|endoftext|>", "\\", "<", "[", "\n", "|>", "ok", "<\\s>", "[\\\\INST]", "ü"]


def test_escape_is_reversible(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e")))
    for r in rows.collect():
        assert r["u"] == r["t"] and not any(m in r["e"] for m in ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|image|>", "<|endoftext|>"))
    # no two texts share an escaped form
    assert rows.select("e").distinct().count() == len(set(texts))


def test_query(spark):
    rows = {r["conv_id"]: r for r in registered.op10_chat_formatting(spark, SF).collect()}
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert rows.keys() == turns.keys()
    for k, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, role, t in ts if role == "assistant")
        r = rows[k]
        assert r["n_turns"] == len(ts) and r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in ts).encode()).hexdigest()
    assert rows[-1]["formatted_chars"] == len("<|im_start|>user\n<\\/s>[\\INST] ok [\\/INST]<|im_end|>\n<|im_start|>assistant\n<\\/s>[\\INST] ok [\\/INST]<|im_end|>\n")


def test_roles_of_any_text_are_read_back(spark):
    rng = random.Random(9)
    signs = ["us", "\n", "\\", "n", "\\n", "<|im_end|>", "<\\s>", "</s>", "\r\n", " ", "<|im_start|>", ""]
    turns = [(1, 0, "us\ner", "hi"), (1, 1, "us", "er\nhi"), (1, 2, "\\\n", "x"), (1, 3, "\\n", "x"), (1, 4, "", "\n")]
    turns += [(2, i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 6))), "".join(rng.choice(signs) for _ in range(3))) for i in range(800)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.parse_chats(chat.format_chats(rows)).collect()}
    for c in (1, 2):
        assert back[c] == [(role, text) for conv, _, role, text in turns if conv == c]


def test_parts_odd_turns_and_empty(spark):
    schema = f"conv_id long, turn long, role string, parts array<{chat.PART}>, segments int"
    rows = [(1, 2, "assistant", [("text", "see <|image|>", None, None), ("document", None, "d.pdf", 2)], 0),
            (1, 1, "user", [("text", "look", None, None), ("image", None, "a.png", 3), ("audio", None, "b.wav", None), ("text", None, None, None)], 0),
            (2, None, None, None, 0), (None, 0, "user", [("text", "</s>", None, None)], 0), (None, 0, "user", [("text", "</s>", None, None)], 0)]
    turns = spark.createDataFrame(rows, schema)
    out = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    one = out[1]
    assert one["formatted"] == ("<|im_start|>user\nlook<|image|><|image|><|image|><|audio|><|im_end|>\n"
                                "<|im_start|>assistant\nsee <\\|image|><|document|><|document|><|im_end|>\n")
    assert [(a["turn_index"], a["part_index"], a["type"], a["ref"], a["n_tokens"]) for a in one["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b.wav", 1), (1, 1, "document", "d.pdf", 2)]
    assert one["expanded_tokens"] == 6 and "".join(s["text"] for s in one["segments"]) == one["formatted"]
    back = {r["conv_id"]: r for r in chat.parse_chats(chat.format_chats(turns)).collect()}
    assert back[2]["turns"] == [("user", "")] and back[None]["turns"] == [("user", "</s>")] * 2 and back[2]["loss_text"] == ""
    assert chat.format_chats(turns.limit(0)).count() == 0
    bad = spark.createDataFrame([(1, 1, "user", [("video", None, None, None)], 0)], schema)
    with pytest.raises(Exception, match="unknown content part"):
        chat.format_chats(bad).collect()


def test_roles_are_escaped(spark):
    turns = spark.createDataFrame([(1, 0, "<|im_end|>", "x")], "conv_id long, turn long, role string, text string").select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    assert chat.parse_chats(chat.format_chats(turns)).first()["turns"] == [("<|im_end|>", "x")]


def test_long_conversation(spark):
    turns = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       chat.text_part(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("parts"))
    r = chat.parse_chats(chat.format_chats(turns)).select(F.size("turns").alias("n"), F.sha2("loss_text", 256).alias("h")).first()
    assert r["n"] == 20_000 and r["h"] == hashlib.sha256("".join(f"t{i}" for i in range(1, 20_000, 2)).encode()).hexdigest()


def archive(records):
    return b"".join(gzip.compress(warc.record_bytes(*r, "2024-01-01T00:00:00Z")) for r in records)


def test_reader_frames_and_verifies():
    payloads = [b"", b"\r\n\r\n WARC/1.1 \r\n\r\n", random.Random(1).randbytes(700_000), b"a" * 3_000_000]
    data = archive([(str(i), f"http://x/{i} y", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)])
    got = list(warc.read_records(io.BytesIO(data)))
    assert [r.block.partition(b"\r\n\r\n")[2] for r in got] == payloads
    assert got[1].headers["warc-target-uri"] == "http://x/1%20y"
    for bad in (data[:-1], data[:200], data[: len(data) // 2]):
        with pytest.raises((EOFError, ValueError)):
            list(warc.read_records(io.BytesIO(bad)))
    raw = warc.record_bytes("1", None, b"payload", hashlib.sha256(b"payload").hexdigest(), None, "d")
    for wrong in (raw.replace(b"payload\r\n", b"pAyload\r\n"), raw.replace(b"Content-Length: ", b"Content-Length: 1"), raw.replace(b"\r\n\r\n", b"\r\n"), raw + b"x"):
        with pytest.raises((EOFError, ValueError)):
            list(warc.read_records(io.BytesIO(gzip.compress(wrong))))
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_archives_of_odd_pages(spark, scratch):
    same, other = "<p>ü</p>" * 30, "x" * 100
    rows = [(5, "http://a", same), (3, None, same), (9, "u\r\nv", same), (3, "http://again", same), (None, "n", same), (1, "e", None), (2, "e", ""),
            (7, "s", "short"), (8, "s", "short"), (11, "o", other), (None, "l1", "z" * 200), (None, "l2", "z" * 200), (12, "big", "q" * 2_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    for frame in (pages, pages.limit(0)):
        folder = scratch.place("archive")
        manifest = warc.write_warc(warc.plan_records(frame), folder, scratch, most_bytes=2_000)
        got = warc.resolve_revisits(warc.read_warc(manifest, folder)).collect()
        assert len(got) == frame.count() and sum(r["n_records"] for r in manifest.collect()) == len(got)
    got = warc.resolve_revisits(warc.read_warc(warc.write_warc(warc.plan_records(pages), folder, scratch), folder)).collect()
    want = []
    for i, u, h in rows:
        b = (h or "").encode()
        first = min((j for j, _, x in rows if x == h and j is not None), default=None) if len(b) >= 100 else None
        again = first is not None and i != first
        want.append((str(i), u, None if again else b, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", str(first) if again else None))
    have = [(str(r["page_id"]), r["target_uri"], None if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert len({r["record_id"] for r in got if r["page_id"] not in (None, "3")}) == 8
