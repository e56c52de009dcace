from clockroll.sources.measures import (JSON_SCHEMA, MEASURE_COLUMNS, events_as_json,
                                        measures_from_events, measures_from_lineitem,
                                        parse_measures, read_json_measures, read_kafka_measures,
                                        valid_measures)

__all__ = ["JSON_SCHEMA", "MEASURE_COLUMNS", "events_as_json", "measures_from_events",
           "measures_from_lineitem", "parse_measures", "read_json_measures",
           "read_kafka_measures", "valid_measures"]
