"""Git as a sink of dated changes: working-tree changes, files of the last commit, backdated commits.

Thin calls of the ``git`` program on one repository on the driver; what is
committed comes from the event tables.
"""

from __future__ import annotations

import os
import subprocess


def _git(repo: str, *args: str, env: dict[str, str] | None = None, check: bool = True) -> str:
    done = subprocess.run(["git", "-C", repo, *args], capture_output=True, text=True, env={**os.environ, **(env or {})})
    if check and done.returncode:
        raise OSError(f"git {args[0]}: {done.stderr.strip()}")
    return done.stdout if not done.returncode else ""


def init(repo: str) -> None:
    """A repository at a folder, if there is none."""
    os.makedirs(repo, exist_ok=True)
    if not os.path.isdir(os.path.join(repo, ".git")):
        _git(repo, "init", "-q")


def changes(repo: str, prefix: str = "") -> list[tuple[str, str]]:
    """(status, path) of what differs from the last commit, untracked files as added; status is A, M or D."""
    listed = _git(repo, "-c", "core.quotePath=off", "status", "--porcelain=v1", "--untracked-files=all", "--no-renames", "-z")
    out = []
    for entry in filter(None, listed.split("\0")):
        code, path = entry[:2], entry[3:]
        status = "A" if "?" in code or "A" in code else "D" if "D" in code else "M"
        if path.startswith(prefix):
            out.append((status, path))
    return sorted(out, key=lambda x: x[1])


def head_file(repo: str, path: str) -> str | None:
    """A file as the last commit has it, or None."""
    return _git(repo, "show", f"HEAD:{path}", check=False) or None


def commit(repo: str, message: str, day: str, paths: list[str] | None = None, *, author: str = "corpus <corpus@localhost>") -> str | None:
    """Commit paths, or everything, as of a day; the commit's id, or None if nothing changed."""
    _git(repo, "add", "-A", "--", *(paths or ["."]))
    if not _git(repo, "diff", "--cached", "--name-only"):
        return None
    name, _, mail = author.rstrip(">").partition(" <")
    stamp = f"{day[:10]}T00:00:00+00:00"
    who = {"GIT_AUTHOR_NAME": name, "GIT_AUTHOR_EMAIL": mail, "GIT_COMMITTER_NAME": name, "GIT_COMMITTER_EMAIL": mail}
    _git(repo, "commit", "-q", "-m", message, env={**who, "GIT_AUTHOR_DATE": stamp, "GIT_COMMITTER_DATE": stamp})
    return _git(repo, "rev-parse", "HEAD").strip()
