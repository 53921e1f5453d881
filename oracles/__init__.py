"""The registered queries as SQL for another engine, to compare results with."""
