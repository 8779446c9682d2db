"""Message schemas: `{"name", "fields": {column: tag}, "required": [column]}`."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

log = logging.getLogger(__name__)

# The type tags of the schema language and their Spark types.
TAG_TYPES = {"str": "string", "int": "bigint", "float": "double", "bool": "boolean"}

# Further spellings, in any letter case, that the strict policy knows.
STRICT_TAG_ALIASES = {"string": "str", "integer": "int", "number": "float", "boolean": "bool"}


@dataclass(frozen=True)
class Schema:
    name: str
    fields: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    found: bool = True

    def tag(self, column: str, policy: str) -> str:
        """The type tag of a column; a tag nobody knows means text."""
        tag = self.fields[column]
        if policy == "strict":
            tag = STRICT_TAG_ALIASES.get(tag.lower(), tag.lower())
        return tag if tag in TAG_TYPES else "str"

    @property
    def columns(self) -> list[str]:
        """Every column a message is read for: the fields, then required names outside them."""
        return [*self.fields, *(c for c in self.required if c not in self.fields)]


# The two shipped schemas.
LOGIN = Schema(
    "app_log_type_login",
    {
        "event_id": "str",
        "log_type": "str",
        "ip_address": "str",
        "event_timestamp": "str",
        "user_id": "str",
        "user_agent": "str",
        "country_code": "str",
    },
    ("event_id", "log_type", "ip_address", "event_timestamp", "user_id"),
)
EXFIL = Schema(
    "app_log_type_exfil",
    {
        "event_id": "str",
        "log_type": "str",
        "ip_address": "str",
        "event_timestamp": "str",
        "user_id": "str",
        "file_size": "int",
        "destination": "str",
    },
    ("event_id", "log_type", "ip_address", "event_timestamp", "user_id"),
)


def load_schemas(folder: str | Path, *, on_error: str = "raise") -> dict[str, Schema]:
    """Read every `*.json` of a folder; the file stem is the schema's name.

    A missing folder gives no schemas. A broken file raises, or is left out with
    `on_error="skip"`.
    """
    folder = Path(folder)
    if not folder.is_dir():
        log.warning("schema folder not found: %s", folder)
        return {}
    schemas = {}
    for path in sorted(folder.glob("*.json")):
        try:
            text = json.loads(path.read_text(encoding="utf-8"))
            schemas[path.stem] = Schema(
                path.stem, dict(text.get("fields") or {}), tuple(text.get("required") or ())
            )
        except (ValueError, TypeError, AttributeError):
            if on_error == "raise":
                raise
            log.warning("schema file left out, it cannot be read: %s", path)
    return schemas


def find_schema(schemas: Mapping[str, Schema], name: str) -> Schema:
    """The named schema, or one that rejects every message when there is none."""
    return schemas.get(name) or Schema(name, found=False)
