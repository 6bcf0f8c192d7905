from stratum.sinks.tables import compact, create_schema, publish_table, publish_view, write_table

__all__ = ["compact", "create_schema", "publish_table", "publish_view", "write_table"]
