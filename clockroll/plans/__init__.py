from clockroll.plans.catalog import ORACLE_SQL, QUERIES, flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
