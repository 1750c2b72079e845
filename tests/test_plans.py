"""No registered query may plan a cartesian product or a nested-loop join."""

import os
import sys

from .conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


def test_no_forbidden_operators(spark):
    """All parts of the plan, those before a checkpoint or a written table included."""
    import __spark_entry__ as E
    from plan_audit import parts_of, summarise
    bad = {}
    for name, fn in E.queries().items():
        for part in parts_of(spark, fn, SF001):
            if found := summarise(part)["forbidden"]:
                bad[name] = found
    assert bad == {}
