"""DataFrame -> DataFrame operators: cleaning, facts, tags, nested star schema, text, ranking,
rosters, tournament, grades, labels."""
