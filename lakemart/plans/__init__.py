"""Stand-in inputs, landing files, registered queries (q_*) and their SQL oracles (o_*)."""
