"""Writers: topic/folder sinks, dimension upsert, JDBC append, dead letters."""
