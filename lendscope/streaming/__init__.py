"""Loading in bounded chunks as a stream that ends when its input does."""
