"""DataFrame -> DataFrame operators over role-named columns."""
