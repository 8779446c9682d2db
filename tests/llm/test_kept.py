from __future__ import annotations

from logscore.llm.kept import Kept


def test_what_is_asked_for_again_stays():
    table = Kept(3)
    table.update(a=1, b=2, c=3, d=4)
    table.turn()
    assert not table and table.missing({"a", "x"}) == {"x"}
    assert table == {"a": 1}
    table.update(x=5, y=6, z=7)
    table.turn()
    assert table.missing({"a", "b", "y"}) == {"b"}
    assert table == {"a": 1, "y": 6}
