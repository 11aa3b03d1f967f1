"""Writers: catalog tables, run archive and manifest, JDBC warehouse."""
