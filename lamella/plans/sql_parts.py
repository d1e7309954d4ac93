"""Parts of SQL that several modules use. Character classes are spelled out alike on both sides."""

from __future__ import annotations

SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
STRIPPED = rf"regexp_replace(%s, '^{SPACE}+|{SPACE}+$', '', 'g')"
SIGNATURE = rf"lower(regexp_replace({STRIPPED % (f'''regexp_replace(line, '{SPACE}+', ' ', 'g')''')}, '\p{{Nd}}+', '#', 'g'))"


def words(text: str) -> str:
    """Stretches without white space."""
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda w: w <> '')"
