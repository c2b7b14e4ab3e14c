"""DataFrame operators: schema handling, row rules, set rules, audits."""
