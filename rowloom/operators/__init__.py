"""DataFrame operators: spines, dictionaries, rules, generation, ranges, rollups, audits."""
