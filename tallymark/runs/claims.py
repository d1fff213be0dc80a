"""Claims of run keys that two publishers cannot share.

Claims form a chain of small files, `<number>.claim`. A claim holds the last key it takes;
the next one begins after it. A publisher reads the end of the chain, works out its keys and
creates the next file, which succeeds for one publisher only; the others read again. So keys
are distinct, and dense for all claims, without a lock and without waiting on a publisher
that died: its keys stay unused, and the chain goes on.

Keys already in a run log or claimed in a table by an older publisher are passed over. Claims
are removed by nothing here: a chain cut at its end would give keys again. At some dozens of
runs a day listing them costs less than a Spark job for years.
"""

from __future__ import annotations

import json

from tallymark.sinks.folders import Folder

SUFFIX = ".claim"
RETRIES = 10_000


class ClaimFailed(RuntimeError):
    """Other publishers were faster each time."""


def _last(folder: Folder) -> tuple[int, int]:
    """Number and last key of the newest claim, (-1, -1) without one."""
    names = [e.name for e in folder.entries() if e.name.endswith(SUFFIX)]
    if not names:
        return -1, -1
    return int(names[-1].removesuffix(SUFFIX)), json.loads(folder.read(names[-1]))["last_key"]


def claim(folder: Folder, control_type: int, width: int = 1, least: int = 0) -> int:
    """Take `width` keys in a row, none below `least`, and return the first."""
    if width < 1:
        raise ValueError("a claim takes at least one key")
    for _ in range(RETRIES):
        number, last = _last(folder)
        first = max(last + 1, least)
        text = json.dumps({"first_key": first, "last_key": first + width - 1, "control_type": control_type})
        if folder.create_once(f"{number + 1:012d}{SUFFIX}", text):
            return first
    raise ClaimFailed(f"no claim after {RETRIES} attempts in {folder.root}")
