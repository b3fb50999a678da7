"""DataFrame -> DataFrame operators; none of them reads or writes files."""
