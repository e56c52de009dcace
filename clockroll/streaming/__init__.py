from clockroll.streaming.job import (emissions_stream, replay_emissions, replay_to_table,
                                     start_rejects_query, start_rollup_queries,
                                     start_rollup_query)

__all__ = ["emissions_stream", "replay_emissions", "replay_to_table", "start_rejects_query", "start_rollup_queries",
           "start_rollup_query"]
