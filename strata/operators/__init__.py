"""DataFrame -> DataFrame operators.

dedupe     one row per key under a total order (partial top-1 before the shuffle)
filters    required columns not NULL
clean      dedupe -> required -> text rules, from a CleanSpec
summarise  group/aggregate (optional pre-aggregated left join), from a SummarySpec
joins      joins that broadcast a side only after measuring it
quality    per-column metrics, quarantine of dropped rows, schema contracts
merge      upsert and change-capture apply
history    validity ranges of versions, with hot keys sliced
"""
