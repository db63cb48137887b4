"""DataFrame -> DataFrame operators without actions."""
