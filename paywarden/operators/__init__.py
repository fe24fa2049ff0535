"""DataFrame -> DataFrame transforms; none of them writes anything."""
