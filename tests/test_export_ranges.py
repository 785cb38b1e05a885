"""Exports read by ranges of any size give what one task gives, in every encoding."""

import random

import pytest

from palaver.sources import chat, export_ranges

PIECES = [
    "2024. 1. {d}. 9:0{m}, Ann : hi {k}", "2024. 1. {d}. 9:0{m}, Bob : 안녕 {k}", "2024. 1. {d}. 9:0{m}, Cy : ", "2024. 1. {d}. 9:0{m}: Dee joined", "", "   ", "2024년 1월 {d}일",
    "Saved Date : x", "goes on {k}", "  계속 {k}  ", "a\x0bb\x0cc", "메시지가 삭제되었습니다",
]


def export(seed, n, end="\n"):
    rng = random.Random(seed)
    return "".join(rng.choice(PIECES).format(d=rng.randrange(1, 29), m=rng.randrange(10), k=k) + rng.choice([end, end, "\r\n", "\n"]) for k in range(n))


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select("source_file", "seq", "ts", "speaker", "text").collect())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("exports")
    for k, encoding in enumerate(("utf-8", "utf-8-sig", "cp949", "euc-kr", "utf-16")):
        (path / f"{encoding}.txt").write_bytes(export(k, 250).encode(encoding))
    (path / "no-end.txt").write_bytes(export(9, 40).rstrip().encode())
    (path / "ends.txt").write_bytes(export(8, 60, "\r").encode())
    (path / "empty.txt").write_bytes(b"")
    (path / "_hidden.txt").write_bytes(b"2024. 1. 1. 9:00, Ann : not read\n")
    (path / "lost.txt").write_bytes(b"2024. 1. 1. 9:00, Ann : \xff\xff\xff!\n")
    (path / "bad.txt").write_bytes((export(7, 50) + "2024. 13. 1. 9:00, Ann : a bad month\n" + export(6, 50)).encode())
    return path


@pytest.mark.parametrize("split", [1 << 26, 300, 17])
@pytest.mark.parametrize("system", [False, True])
def test_ranges_against_whole_texts(spark, folder, split, system):
    texts = []
    for f in sorted(folder.iterdir()):
        content = f.read_bytes()
        text = next((t for e in chat.ENCODINGS if (t := export_ranges._decoded(content, e)) is not None), None)
        if f.name[0] != "_":
            texts.append((f.name, text))
    want = rows_of(chat.messages(spark.createDataFrame(texts, "source_file string, text string"), system))
    if split == 17:  # some files only: a task for each 17 bytes
        keep = "ends.txt", "no-end.txt", "utf-16.txt"
        want = [r for r in want if r[0] in keep]
        found = [chat.export_messages(spark, str(folder / k), system, split) for k in keep]
        assert sorted(x for df, _ in found for x in rows_of(df)) == want
        return
    df, lost = chat.export_messages(spark, str(folder), system, split)
    assert rows_of(df) == want and len(want) > 200
    assert [x.rpartition("/")[2] for x in lost] == ["lost.txt"]


def test_long_text_in_many_windows(spark, monkeypatch):
    frame = spark.createDataFrame([("f", export(3, 500)), ("g", export(4, 20)), ("h", None)], "source_file string, text string")
    want = rows_of(chat.messages(frame))
    monkeypatch.setattr(chat, "LINES", 7)
    assert rows_of(chat.messages(frame)) == want


def test_patterns_and_no_file(spark, folder):
    df, _ = chat.export_messages(spark, str(folder / "utf-*.txt"))
    assert {r[0] for r in rows_of(df)} == {"utf-8.txt", "utf-8-sig.txt", "utf-16.txt"}
    with pytest.raises(Exception, match="no file matches"):
        chat.export_messages(spark, str(folder / "none-*.txt"))


def test_many_ranges_a_task(spark, folder):
    """A task for every range would be thousands of tasks."""
    reader = export_ranges.ExportReader({"path": str(folder), "split": "17", "ends": chat.LINE_END})
    assert len(reader.partitions()) == 1 and len(reader.partitions()[0].ranges) > 1000


def test_files_in_parts(spark, folder, tmp_path):
    """A folder of parts is one file: line numbers and open messages go on from part to part."""
    for k, name in enumerate(("one", "two", "lost")):
        rows = export(20 + k, 120).splitlines(keepends=True)
        (tmp_path / "whole").mkdir(exist_ok=True)
        (tmp_path / "parts" / name).mkdir(parents=True)
        data = [t.encode("cp949" if k else "utf-8") for t in rows]
        data = [d + b"\xff\xff\xff\n" if name == "lost" else d for d in data]
        (tmp_path / "whole" / name).write_bytes(b"".join(data))
        ends, at = [i + 1 for i, d in enumerate(data) if d.endswith(b"\n")], 0
        for n, end in enumerate([*ends[10::25], len(data)]):
            (tmp_path / "parts" / name / f"part-{n:05}").write_bytes(b"".join(data[at:end]))
            at = end
    for split in (1 << 26, 300):
        whole, _ = chat.export_messages(spark, str(tmp_path / "whole"), split=split)
        parts, lost = chat.export_messages(spark, str(tmp_path / "parts"), split=split, parts=True)
        assert rows_of(parts) == [r for r in rows_of(whole) if r[0] != "lost"] and len({r[0] for r in rows_of(parts)}) == 2
        assert [x.rpartition("/")[2] for x in lost] == ["lost"]
