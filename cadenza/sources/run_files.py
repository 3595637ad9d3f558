"""The small files of one run: preflight, generator inputs and outputs, logs, review clips,
delivery, and the report of a run that failed."""

from __future__ import annotations

import csv
import hashlib
import json
import os
import shlex
import shutil
import subprocess
import time
import traceback
from collections.abc import Callable, Iterable
from pathlib import Path

# Columns of the lists that a run writes, and how much of a long text is shown.
SEGMENT_COLUMNS = ("segment_id", "text", "paragraph_after")
EDIT_COLUMNS = ("start_frame", "end_frame", "start_seconds", "end_seconds", "duration_ms_before", "target_duration_ms", "delete_start_frame", "delete_end_frame", "deleted_frames")
REVIEW_COLUMNS = ("segment_id", "audio_file", "text", "seed", "round_index", "duration_seconds", "final_start_seconds", "final_end_seconds", "sample_sha256", "file_sha256", "source_file_sha256", "postprocessed")
SHOWN_IDS, SHOWN_PROBE, SHOWN_COMMAND, SHOWN_LINE = 8, 500, 2000, 1000


def run_id(now: float | None = None) -> str:
    return time.strftime("%Y%m%d-%H%M%S", time.localtime(now))


def preflight(config: dict, files: Iterable[str], folders: Iterable[str] = ()) -> None:
    """Raise if a named path is not there, or the reference's text is empty in combined mode."""
    p = config["paths"]
    missing = [k for k in files if not Path(p[k]).is_file()] + [k for k in folders if not Path(p[k]).is_dir()]
    if missing:
        raise FileNotFoundError("环境预检失败：" + ", ".join(missing))
    if config["generation"].get("reference_mode") == "combined" and not Path(p["reference_text_file"]).read_text(encoding="utf-8").strip():
        raise ValueError("combined参考模式的参考文字不能为空")


def check_lengths(lengths: Iterable[tuple[str, int]], limit: int) -> None:
    """Raise if a segment (id, characters) is longer than the limit; the first eight are named."""
    over = [f"{name}={n}字" for name, n in lengths if n > limit]
    if over:
        raise ValueError(f"安全检查拒绝生成：存在超过{limit}字的单段（{'、'.join(over[:SHOWN_IDS])}）。请先让AI按语义分段后再运行。")


def free_memory_mb(answer: str, error: str = "") -> int:
    """Of the first device in a memory query's answer."""
    if not answer.strip():
        raise RuntimeError(f"安全检查失败：无法读取GPU显存：{error.strip()[-SHOWN_PROBE:]}")
    return int(float(answer.strip().splitlines()[0].strip()))


def write_effective(folder: str, config: dict, text: str, segments: list[dict]) -> None:
    """The configuration, the reviewed text and the segments as they were used."""
    top = Path(folder)
    (top / "effective_config.json").write_text(json.dumps(config, ensure_ascii=False, indent=2), encoding="utf-8")
    (top / "reviewed_text.txt").write_text(text, encoding="utf-8")
    (top / "validated_segments.json").write_text(json.dumps({"segments": segments}, ensure_ascii=False, indent=2), encoding="utf-8")


def run_command(command: list[str], log: str, **more) -> str:
    """Run a command, keep command and output in a log, return its output; raise if it fails."""
    done = subprocess.run(command, capture_output=True, text=True, encoding="utf-8", errors="replace", check=False, **more)
    Path(log).parent.mkdir(parents=True, exist_ok=True)
    told = subprocess.list2cmdline(command) if os.name == "nt" else shlex.join(command)
    Path(log).write_text(f"COMMAND\n{told}\n\nSTDOUT\n{done.stdout}\nSTDERR\n{done.stderr}", encoding="utf-8")
    if done.returncode:
        raise RuntimeError(f"命令失败，exit={done.returncode}，日志={log}\n{done.stderr[-SHOWN_COMMAND:]}")
    return done.stdout


def generate(segments: list[tuple[str, str]], seed: int, folder: str, command: Callable[[str, str, str], list[str]]) -> dict[str, tuple[str, int]]:
    """Segment ids to (audio path, seed) of one round, by position.

    The generator gets a line for each text (line feeds become spaces) and for each seed, the
    round's for all; ``command`` makes its command from the paths of both files and of the
    folder in which it leaves 01.wav, 02.wav and so on. A file that is not there raises.
    """
    top = Path(folder)
    top.mkdir(parents=True, exist_ok=False)
    texts, seeds, out = top / "input.txt", top / "seeds.txt", top / "generated"
    texts.write_text("".join(t.replace("\n", " ") + "\n" for _, t in segments), encoding="utf-8")
    seeds.write_text(f"{seed}\n" * len(segments), encoding="ascii")
    run_command(command(str(texts), str(seeds), str(out)), str(top / "generation.log"), env=os.environ | {"PYTHONHASHSEED": str(seed)})
    found = {}
    for i, (name, _) in enumerate(segments, start=1):
        path = out / f"{i:02d}.wav"
        if not path.is_file():
            raise FileNotFoundError(f"生成结果缺失：{path}")
        found[name] = (str(path), seed)
    return found


def jsonable(value):
    """Plain values; arrays and tuples become lists, other objects their text."""
    if value is None or isinstance(value, str | int | float | bool):
        return value
    if isinstance(value, dict):
        return {str(k): jsonable(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [jsonable(v) for v in value]
    return jsonable(value.tolist()) if hasattr(value, "tolist") else str(value)


def first_object(raw) -> dict:
    """The first entry of a list, or the value itself; it must be an object."""
    out = raw[0] if isinstance(raw, list) and raw else raw
    if not isinstance(out, dict):
        raise RuntimeError("the recognizer returned a result that is no object")
    return out


def write_envelope(path: str, worker: dict, results: Iterable[dict]) -> None:
    """One worker's results as ``{worker, results}``, which read_results() reads."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps({"worker": jsonable(worker), "results": [jsonable(r) for r in results]}, ensure_ascii=False, indent=2), encoding="utf-8")


def _sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def export_review(folder: str, rows: list[dict]) -> dict[str, str]:
    """Copy the clips of review rows into review_segments, hold each copy against its source, and
    write review_segments.csv. Returns the folder's and the list's path."""
    top, listed = Path(folder), []
    clips = top / "review_segments"
    clips.mkdir(parents=False, exist_ok=False)
    for r in rows:
        source, copy = Path(r["audio_path"]), clips / f"{r['segment_id']}.wav"
        shutil.copyfile(source, copy)
        there, here = _sha256(source), _sha256(copy)
        if there != here:
            raise OSError(f"审听片段复制后文件发生变化：{r['segment_id']}")
        listed.append({**r, "audio_file": str(copy), "file_sha256": here, "source_file_sha256": there})
    manifest = top / "review_segments.csv"
    write_list(str(manifest), REVIEW_COLUMNS, listed)
    return {"review_dir": str(clips), "manifest_path": str(manifest)}


def write_list(path: str, columns: Iterable[str], rows: Iterable[dict]) -> None:
    """A list for people: byte order mark, the header even without rows, no other columns."""
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.DictWriter(f, list(columns), extrasaction="ignore")
        w.writeheader()
        w.writerows(rows)


def deliver(candidate: str, final: str, passed: bool) -> str | None:
    """The final file's path; the name appears only if the whole recording passed its check."""
    if not passed:
        return None
    os.replace(candidate, final)
    return final


def new_runs(root: str, before: set[str]) -> list[str]:
    """Run folders that were not there before, the newest last."""
    found = [p for p in Path(root).iterdir() if p.is_dir() and str(p) not in before]
    return [str(p) for p in sorted(found, key=lambda p: p.stat().st_mtime)]


def report_failure(root: str, before: set[str], error: BaseException, summary: str) -> str | None:
    """Leave a report and the traceback in the newest new run that has no report; its path."""
    runs = new_runs(root, before)
    if not runs or (Path(runs[-1]) / "report.txt").exists():
        return None
    report = Path(runs[-1]) / "report.txt"
    report.write_text(f"音频质量报告\n\n流程状态：技术失败\n错误：{summary[:SHOWN_LINE]}\n最终音频：未生成\n", encoding="utf-8")
    (report.parent / "technical_error.txt").write_text("".join(traceback.format_exception(error)), encoding="utf-8")
    return str(report)
