"""Exports to training files, held against a plain walk over the same messages."""

import datetime as dt
import json
import random

import pytest

from palaver import cli
from palaver.plans import prepare


def exports(folder):
    """Two rooms; messages that are dropped, repeated and merged among them."""
    rng, kept = random.Random(3), {}
    for room in ("a", "b"):
        at, lines, kept[room] = dt.datetime(2024, 3, 1, 9, 0), ["talk 1", "Saved Date : 2024"], []
        for k in range(120):
            at += dt.timedelta(minutes=rng.choice((0, 1, 1, 3, 200)))
            who = rng.choice(("Ann", "Bob", "Cy"))
            text = rng.choice((f"message number {k} of the room", f"message number {k} of the room", "ok", "@x hello there you", "see https://a.b/c now", "same line again"))
            lines.append(f"{at.year}. {at.month}. {at.day}. {at.hour}:{at.minute:02}, {who} : {text}")
            kept[room].append((at, who, text))
        (folder / f"{room}.txt").write_text("\n".join(lines), encoding="utf-8")
    (folder / "bad.txt").write_text("2024. 13. 1. 9:00, Ann : hi there everyone", encoding="utf-8")
    return kept


def walked(kept):
    """Sessions of merged messages in order of time, and the counts on the way."""
    n, sessions = {"parsed": 0, "low_signal": 0, "mention_artifact": 0, "deduplicated": 0, "merged_into_previous": 0}, []
    for room, rows in kept.items():
        seen, merged = set(), []
        for at, who, text in rows:
            n["parsed"] += 1
            text = text.replace("https://a.b/c", "<URL>")
            if text in ("ok", "@x hello there you"):
                n["low_signal" if text == "ok" else "mention_artifact"] += 1
            elif (at, who, text) in seen:
                n["deduplicated"] += 1
            else:
                seen.add((at, who, text))
                last = merged[-1] if merged else None
                if last and last[1] == who and (at - last[0]).total_seconds() <= 120 and len(last[2]) + 1 + len(text) <= 320:
                    merged[-1] = (at, who, last[2] + "\n" + text)
                    n["merged_into_previous"] += 1
                else:
                    merged.append((at, who, text))
        own = []
        for row in merged:
            if not own or (row[0] - own[-1][-1][0]).total_seconds() > 180 * 60:
                own.append([])
            own[-1].append(row)
        sessions += [(s[0][0], room, k, s) for k, s in enumerate(own)]
    return n, sorted(sessions, key=lambda s: s[:3])


def lines_of(path):
    return [json.loads(line) for f in sorted(path.glob("*.json")) for line in f.read_text(encoding="utf-8").splitlines()]


def test_preprocess(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    kept, out = exports(tmp_path / "in"), tmp_path / "out"
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"share": 0.2, "window": 4, "window_stride": 2, "least_messages": 2, "shortest_chunk": 20}))
    assert cli.main(["preprocess", str(tmp_path / "in"), str(out), "--system", "Be kind.", "--task", "Answer.", "--config", str(config)]) == 0
    printed = {tuple(line.split("\t")[:2]): int(line.split("\t")[2]) for line in capsys.readouterr().out.splitlines() if line.count("\t") == 2}
    n, sessions = walked(kept)
    assert {k: printed["messages", k] for k in n} == n
    cut = min(max(int(len(sessions) * 0.8), 1), len(sessions) - 1)
    line = lambda m: f"{m[1]}: {' '.join(m[2].split(chr(10)))}"
    for split, part in (("train", sessions[:cut]), ("val", sessions[cut:])):
        assert printed["sessions", split] == len(part)
        want, chunks = [], []
        for _, room, _, rows in part:
            for k in range(2, len(rows)):
                at, who, text = rows[k]
                meta = {"split": split, "source_file": f"{room}.txt", "target_speaker": who, "target_timestamp": at.isoformat(timespec="minutes"), "context_turns": min(8, k)}
                want.append((" ".join(text.split("\n")), meta, [line(m) for m in rows[max(0, k - 8) : k]]))
            chunks += ["\n".join(map(line, rows[k : k + 4])) for k in range(0, len(rows), 2) if len(rows[k : k + 4]) >= 2]
        got = lines_of(out / split)
        assert [(g["response"], g["meta"]) for g in got] == [w[:2] for w in want]
        assert all("\n".join(w[2]) in g["prompt"] and "Be kind." in g["prompt"] for g, w in zip(got, want, strict=True))
        assert [g["text"] for g in lines_of(out / f"cpt_{split}")] == chunks
        assert printed[split, "kept"] == len(want) and printed[f"cpt_{split}", "kept"] == len(chunks)


def test_cap_and_errors(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    exports(tmp_path / "in")
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"share": 0.5, "cap": 3, "system": "s", "task": "t"}))
    cli.main(["preprocess", str(tmp_path / "in"), str(tmp_path / "out"), "--config", str(config)])
    assert len(lines_of(tmp_path / "out" / "train")) == len(lines_of(tmp_path / "out" / "val")) == 3
    capsys.readouterr()
    cli.main(["errors", str(tmp_path / "in")])
    assert capsys.readouterr().out.strip() == "bad.txt\tbad time: 2024. 13. 1. 9:00"


def test_settings():
    with pytest.raises(ValueError, match="system and task"):
        prepare.settings_of({"system": " "})
    with pytest.raises(ValueError, match="unknown"):
        prepare.settings_of({"system": "a", "task": "b", "nope": 1})
