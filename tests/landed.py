"""Small landed days for tests."""

import datetime as dt
import gzip
import json
import os

from eventmill.schema import KNOWN_EVENT_TYPES

DAY = dt.date(2024, 1, 10)
NEXT = dt.date(2024, 1, 11)


def event(i, day=DAY, hour=0, **fields):
    record = {
        "id": str(i),
        "type": KNOWN_EVENT_TYPES[i % len(KNOWN_EVENT_TYPES)],
        "actor": {"id": i % 5, "login": f"actor{i % 5}", "display_login": "d", "gravatar_id": "", "url": "u", "avatar_url": "a"},
        "repo": {"id": i % 7, "name": f"repo{i % 7}", "url": "u"},
        "payload": {"action": "opened", "number": i},
        "public": True,
        "created_at": f"{day}T{hour:02d}:{i % 60:02d}:00Z",
    }
    record.update(fields)
    return {k: v for k, v in record.items() if v is not ...}


def land(raw_dir, day, hour, records, newline=True, part=None):
    """Write one hourly file, or a part of an hour that is a folder; a record may be raw text."""
    folder = f"{raw_dir}/{day:%Y/%m/%d}" + ("" if part is None else f"/{hour}.json.gz")
    os.makedirs(folder, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with gzip.open(f"{folder}/{hour if part is None else f'part-{part:05d}'}.json.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + ("\n" if newline and lines else ""))


def land_day(raw_dir, day=DAY, per_hour=10, start=0, **fields):
    """A whole clean day of all types, unless ``fields`` say otherwise."""
    i = start
    for hour in range(24):
        land(raw_dir, day, hour, [event(i + n, day, hour, **fields) for n in range(per_hour)])
        i += per_hour
    return i - start
