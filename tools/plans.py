"""Print the exchanges, joins and aggregations that every registered sensor query plans, as a Markdown table.

Usage: python tools/plans.py [sf_dir]
"""
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorlake.plans.catalog import QUERIES
from sensorlake.session import local_session, scratch

sf = sys.argv[1] if len(sys.argv) > 1 else '/root/testdata/sf0.01'
spark = local_session(8)


def counted(found):
    return ', '.join(f"{k}×{n}" if n > 1 or '(' not in k else k for k, n in sorted(Counter(found).items())) or 'none'


print('| query | exchanges | joins | aggregation |\n|---|---|---|---|')
for name, fn in QUERIES.items():
    with scratch(spark):
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    joins = re.findall(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b", plan)
    agg = 'partial+final' if 'partial_' in plan else ('—' if 'Aggregate' not in plan else 'distinct')
    print(f"| `{name}` | {counted(exchanges)} | {counted(joins)} | {agg} |", flush=True)
